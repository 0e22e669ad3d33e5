import random
import re
from collections import Counter

import duckdb
from edge_cases import edge_rows
from pyspark.sql import functions as F

from rollmatch.llm import quality_rules as Q
from rollmatch.llm.oracles import ORACLES
from rollmatch.llm.quality_rules import CLASSES, COMMON_WORDS, judge, keep_good


def expected(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 10 or 100 * len(inside) > 20 * n)


def test_counts_match_brute_force(edge):
    got = judge(edge).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                             "base_failed", "kept").collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert tuple(r)[2:8] == expected(r.text), r.doc_id
        assert not (r.kept and r.base_failed)


def test_unlike_documents_go_and_short_ones_are_not_compared(spark, table):
    good = "the man and the dog went to the old town in the evening and it was late on that day " * 3
    rows = [(i, " ".join(f"{w}{i}" if k % 7 == 0 else w for k, w in enumerate(good.split() * 3)), "en") for i in range(30)]
    rows = [(i, " ".join(sorted(t.split(), key=lambda w: hash((w, i)) % 97)), lang) for i, t, lang in rows]
    noise = " ".join(f"%%{i}**&&{i}##" for i in range(200))
    got = {r.doc_id: r for r in judge(table(rows + [(90, noise, "en"), (91, noise[:120], "en")],
                                            "doc_id long, text string, lang string")).collect()}
    assert not got[90].kept and got[90].char_bits > 0.3 and not got[90].base_failed
    assert got[91].char_bits is None and got[91].kept


def test_keep_good_returns_the_input_columns(edge, empty):
    assert keep_good(edge).schema == edge.schema
    assert keep_good(empty).count() == 0 and judge(empty).count() == 0


def test_class_patterns_and_words_are_distinct():
    assert len(set(CLASSES)) == len(CLASSES) and len(set(COMMON_WORDS)) == len(COMMON_WORDS)


def test_a_missing_label_is_judged_by_the_nearest_language(spark, table):
    common = {"en": "the of and to in is that for it was on are with", "de": "der die und das den von zu mit ist ein",
              "es": "el los del las por con se para que"}
    rng = random.Random(5)

    def text(lang):
        return " ".join(rng.choice(common[lang].split()) if rng.random() < 0.5 else
                        "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(300))

    rows = [(i, text(lang), lang) for i, lang in enumerate(["en", "de", "es"] * 20)]
    rows += [(100 + i, text(lang), None) for i, lang in enumerate(["en"] * 15 + ["de"] * 3 + ["es"] * 2)]
    noise = " ".join(f"%%{i}**&&{i}##" for i in range(200))
    rows += [(200, noise, None), (201, "one two", None)]
    schema = "doc_id long, text string, lang string"
    got = {r.doc_id: r for r in judge(table(rows, schema)).collect()}
    assert len(got) == len(rows) and all(r.kept for d, r in got.items() if d < 200)
    assert not got[200].kept and not got[200].base_failed and got[201].char_bits is None and got[201].base_failed
    # The nearest language's divergences are those that its label would have given, near enough.
    named = {r.doc_id: r for r in judge(table([(d, t, "de" if 115 <= d < 118 else lang) for d, t, lang in rows], schema)).collect()}
    assert all(abs(got[d].word_bits - named[d].word_bits) < 0.01 for d in (115, 116, 117))
    # No label at all: nothing to compare with.
    assert all(r.kept and r.word_bits is None for r in judge(table(rows[60:80], schema)).collect())


def test_the_sql_agrees_where_labels_are_missing(spark, tmp_path, monkeypatch):
    """Every seventh label is null; references in blocks of one language and all at once give the same."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = str(tmp_path / "documents")
    docs.withColumn("lang", F.when(F.col("doc_id") % 7 != 3, F.col("lang"))).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    con.execute(ORACLES["op3_quality_rules"])
    want = [dict(zip([d[0] for d in con.description], r)) for r in con.fetchall()]
    altered = spark.read.parquet(path).select("doc_id", "text", "lang")
    for sent in (Q.SENT, 1):
        monkeypatch.setattr(Q, "SENT", sent)
        got = judge(altered, carry=["doc_id"]).drop("char_bits", "word_bits").collect()
        assert sorted(str(sorted(r.asDict().items())) for r in got) == sorted(str(sorted(r.items())) for r in want)
