import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from rollmatch.operators import keywords


def make(seed, length):
    rng = random.Random(seed)
    return "".join(rng.choice("abcé ") for _ in range(length))


WORDS = ["a", "bc", "é a", make(1, 7), make(2, 8), make(2, 8) + "b", make(3, 20), make(4, 31), make(5, 32),
         "Senior " * 6 + "cook", "Senior " * 6 + "clerk", make(6, 90), "never there at all in any text"]
TEXTS = [make(100 + i, 60 + i) for i in range(40)] + [
    f"zz{w}zz" for w in WORDS[3:12]] + ["zz" + WORDS[11] + WORDS[6] + "zz", "", "zzz", WORDS[9][:-1]]


@pytest.mark.parametrize("spare", [0, 16])
@pytest.mark.parametrize("listed", [WORDS, WORDS[3:], WORDS[8:], []])
def test_first_listed_keyword(spark, spare, listed, monkeypatch):
    monkeypatch.setattr(keywords, "SPARE", spare)
    texts = spark.createDataFrame(list(enumerate(TEXTS)) + [(999, None)], "id int, text string")
    # Listed twice and with blanks: the first place counts, a blank is no keyword.
    rows_in = [(w, i) for i, w in enumerate(listed)] + [(w, 500 - i) for i, w in enumerate(listed)] + [("", 0)]
    words = spark.createDataFrame(rows_in, "w string, pos int")
    want = [(i, next(w for w in listed if w in t)) for i, t in enumerate(TEXTS) if any(w in t for w in listed)]
    got = keywords.first_keyword(texts, "text", words, "w", "pos", "id")
    assert rows(got) == sorted(want, key=str)
    assert rows(keywords.distinct_keywords(got)) == sorted({(w,) for _, w in want}, key=str)


def test_few_anchors_of_texts_become_rows(spark, tmp_path):
    """Of the texts' anchors, the keywords' own pass, and about one in SPARE of the others at most."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefghij ") for _ in range(400)) for _ in range(300)]
    listed = [texts[i][50:50 + 8 + i % 40] for i in range(0, 300, 3)] + [f"none {i} of them" for i in range(6000)]
    source = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    words = spark.createDataFrame([(w, i) for i, w in enumerate(listed)], "word string, pos int")
    chosen, used = keywords._chosen_anchors(words)
    every = source.select(F.explode(keywords._anchors(used)("text")).alias("anchor"))
    passed = keywords._text_anchor_rows(source, chosen, used)
    own = every.join(chosen.select("anchor").distinct(), "anchor").count()
    assert own <= passed.count() <= own + 1.2 * (every.count() - own) / keywords.SPARE
    found = keywords.first_keyword(source, "text", words, "word", "pos", "id")
    assert rows(found) == sorted(((i, next(w for w in listed if w in t)) for i, t in enumerate(texts)
                                  if any(w in t for w in listed)), key=str)


def test_candidates_of_short_keywords_are_texts_that_hold_most_of_them(spark):
    """Keywords and texts of few syllables share all short substrings; candidates do not grow with every pair of them."""
    rng = random.Random(9)
    made = lambda n: "".join(rng.choice(("the", "ing", "on ", "and", "ea ", "re ")) for _ in range(n))
    texts, listed = [made(150) for _ in range(100)], [made(9) for _ in range(100)]
    source = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    words = spark.createDataFrame([(w, i) for i, w in enumerate(listed)], "word string, pos int")
    chosen, used = keywords._chosen_anchors(words)
    candidates = keywords._text_anchor_rows(source, chosen, used).join(chosen, "anchor").count()
    assert candidates <= 400  # of 10,000 pairs
    found = keywords.first_keyword(source, "text", words, "word", "pos", "id")
    assert rows(found) == sorted(((i, next(w for w in listed if w in t)) for i, t in enumerate(texts)
                                  if any(w in t for w in listed)), key=str)
