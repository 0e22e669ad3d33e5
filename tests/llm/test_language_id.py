from collections import Counter

import numpy as np
from edge_cases import edge_rows

from rollmatch.llm import language_id as G

SF = "/root/testdata/sf0.01"


def counted(text):
    """n-grams of one to three characters, plainly."""
    blank = "".join(c if c.isalpha() else " " for c in text.lower())
    tidy = " " + " ".join(blank.split()) + " " if blank.strip() else ""
    out = Counter()
    for n in (1, 2, 3):
        out.update(tidy[i:i + n] for i in range(len(tidy) - n + 1))
    out.pop(" ", None)
    return out


def test_grams_and_ranks_match_plain_counting():
    for text in ["", "12 .", "Ab, ab!", "é中\U0001f600 ñ", *[r[1] or "" for r in edge_rows()]]:
        codes, counts = G.grams(text)
        names = {"".join(chr(c) for c in (int(x) >> 42, int(x) >> 21 & 0x1FFFFF, int(x) & 0x1FFFFF) if c) for x in codes}
        plain = counted(text)
        assert sorted(counts.tolist()) == sorted(plain.values()) and names == set(plain)
        top = G.ranked(codes, counts, 7)
        order = sorted(zip((-counts).tolist(), codes.tolist()))[:7]
        assert [c for _, c in order] == top.tolist()


def test_distance_is_out_of_place():
    codes = {k: np.array(v, dtype=np.uint64) for k, v in {"x": [97, 98], "y": [98, 97]}.items()}
    assert G.Profiles(codes).predict("aab")[0] == "x" and G.Profiles(codes).predict("abb b")[0] == "y"
    assert G.Profiles({}).predict("abc") == ("und", 0.0)
    assert G.Profiles(codes).predict("... 1") == ("und", 0.0) == G.Profiles(codes).predict(None)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", G.held_out(docs.doc_id))
    profiles = G.fit(docs.filter("NOT held_out"))
    got = G.identify(docs.filter("held_out"), profiles).collect()
    assert len(got) > 200 and all(0 <= r.score <= 1 for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_edge_cases(edge, empty):
    profiles = G.fit(edge, sample=5)
    assert set(profiles.names) == {"en", "es", "de"}  # the text labelled xx has no letter
    out = G.identify(edge, profiles)
    got = {r.doc_id: r.lang_pred for r in out.collect()}
    assert out.count() == len(edge_rows()) and got[2] == got[3] == got[4] == got[11] == "und"
    assert G.identify(empty, profiles).count() == 0 and not G.fit(empty).names
    assert G.identify(edge, G.fit(empty)).filter("lang_pred <> 'und'").count() == 0
