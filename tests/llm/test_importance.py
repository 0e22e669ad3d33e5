import random

import numpy as np
import pytest
from edge_cases import edge_rows, prose
from pyspark.sql import functions as F

from rollmatch.llm import importance as I
from rollmatch.llm.shingles import mixed

LABELS = "doc_id long, quality int, toxic int"


def test_buckets_are_words_and_pairs():
    texts = [r[1] for r in edge_rows()]
    for text, found in zip(texts, I.buckets(texts)):
        n = len((text or "").encode().split())
        assert len(found) == max(0, 2 * n - 1) and (not n or (0 <= found.min() and found.max() < I.FEATURES))
    a, b, c = I.buckets(["The cat", "the  CAT\n", "cat the"])
    assert (a == b).all() and sorted(a[:2]) == sorted(c[:2]) and a[2] != c[2]


@pytest.mark.parametrize("few", [4096, 3])
def test_kth_largest_matches_sorting(spark, monkeypatch, few):
    monkeypatch.setattr(I, "FEW", few)
    rng = random.Random(4)
    values = [rng.choice((rng.gauss(0, 100), 1.5, 1.5, -7.0)) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 150, 399, 400):
        assert I.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_good_documents_weigh_more(spark, table):
    rng = random.Random(5)
    good = [(i, prose(rng, 80)) for i in range(60)]
    bad = [(100 + i, "BUY NOW!! click here to win big prizes " * 8 + str(i)) for i in range(30)]
    labels = table([(i, 1, 0) for i in range(0, 60, 3)] + [(100, 0, 0)] * 9 + [(None, 1, 0), (5, None, 0)], LABELS)
    out = I.resample(table(good + bad, "doc_id long, text string"), labels, share=60 / 90)
    got = {r.doc_id: r for r in out.collect()}
    assert sum(r.kept for r in got.values()) == 60
    assert np.mean([got[i].kept for i in range(60)]) > 0.9
    assert max(got[100 + i].log_weight for i in range(30)) < min(got[i].log_weight for i in range(60))
    again = {r.doc_id: r.noisy for r in I.resample(out.select("doc_id", "text").repartition(7), labels).collect()}
    assert all(abs(again[i] - got[i].noisy) < 1e-9 for i in got)


def test_texts_are_held_part_by_part(spark, table, monkeypatch):
    rng = random.Random(6)
    docs = table([(i, prose(rng, 40)) for i in range(300)] + [(None, None)] * 3, "doc_id long, text string").coalesce(1)
    labels = table([(i, 1, 0) for i in range(0, 300, 7)], LABELS)
    whole = sorted((r.doc_id or -1, round(r.noisy, 9), r.kept) for r in I.resample(docs, labels, share=0.4).collect())
    held = I.buckets

    def few(texts):
        assert len(texts) <= 16
        return held(texts)

    monkeypatch.setattr(I, "buckets", few)
    monkeypatch.setattr(I, "PART", 16, raising=False)
    assert whole == sorted((r.doc_id or -1, round(r.noisy, 9), r.kept) for r in I.resample(docs, labels, share=0.4).collect())


def test_noise_is_gumbel():
    u = I.unit_interval(mixed(np.arange(200_000, dtype=np.uint64)))
    noise = -np.log(-np.log(u))
    assert abs(noise.mean() - 0.5772) < 0.01 and abs(noise.std() - np.pi / 6 ** 0.5) < 0.01


def test_edge_cases(edge, empty, table):
    none = table([], LABELS)
    out = I.resample(edge, none)
    assert out.count() == len(edge_rows()) == out.filter("kept").count()
    assert out.filter("log_weight <> 0").filter(F.col("text").isNull()).count() == 0
    labels = table([(1, 1, 0), (6, 0, 0)], LABELS)
    assert I.resample(empty, labels).count() == 0
    same = I.resample(edge, labels, share=0.3).filter("doc_id = 8").select("noisy", "kept").distinct()
    assert same.count() == 1 and I.resample(edge, labels, share=0.0).filter("kept").count() == 0
