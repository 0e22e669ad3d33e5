import math
import random
from collections import Counter

import pytest

from rollmatch.operators import sparse, vectors

COMMON = ["the", "of", "and", "to"]


def texts(seed, n, words):
    rng = random.Random(seed)
    rare = [f"w{i}" for i in range(words)]
    return [(i, " ".join(rng.choice(COMMON) if rng.random() < 0.5 else rng.choice(rare) for _ in range(rng.randint(3, 30))))
            for i in range(n)]


def brute(queries, items, k):
    n, df = len(items), Counter(t for _, x in items for t in set(x.split()))
    idf = {t: math.log((n + 1) / (d + 1)) for t, d in df.items()}

    def unit(text):
        w = {t: c * idf[t] for t, c in Counter(text.split()).items() if idf.get(t, 0) > 0}
        length = math.sqrt(sum(x * x for x in w.values()))
        return {t: x / length for t, x in w.items()}

    held, out = [(i, unit(x)) for i, x in items], []
    for q, x in queries:
        own = unit(x)
        found = [(-round(s, 9), i) for i, v in held if (s := sum(w * v[t] for t, w in own.items() if t in v)) > 0]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out)


def weighed(spark, queries, items):
    q, i = (spark.createDataFrame(r, "id long, t string") for r in (queries, items))
    fitted = vectors.fit_terms(i, "id", "t")
    return vectors.weigh_terms(q, "id", "t", fitted), vectors.term_weights(i, "id", "t")


@pytest.mark.parametrize("k,words", [(1, 400), (5, 60), (300, 400)])
def test_equals_the_plain_dot_product(spark, k, words):
    items = texts(1, 200, words) + [(500 + i, "the same of w1 w2") for i in range(30)] + [(900, "")]
    queries = texts(2, 40, words) + [(77, "unknown words"), (78, ""), (79, "the same of w1 w2")]
    q, i = weighed(spark, queries, items)
    got = sparse.nearest_by_terms(q, i, k, "id", "id")
    got, want = sorted(map(tuple, got.collect())), brute(queries, items, k)
    assert [r[:3] for r in got] == [r[:3] for r in want] and all(abs(a[3] - b[3]) < 1e-8 for a, b in zip(got, want))
    assert sparse.nearest_by_terms(q.limit(0), i, k, "id", "id").count() == 0


def test_frequent_terms_bring_no_candidates(spark):
    """Each query has one rare term that decides; the candidates are far fewer than the items that share any term."""
    items = [(i, f"the of and to w{i} w{i} w{i}") for i in range(300)] + [(1000 + i, "the of and to") for i in range(3)]
    queries = [(q, f"the of w{q}") for q in range(20)]
    q, i = weighed(spark, queries, items)
    asked = sparse.unit_weights(q, "id").selectExpr("id AS q", "term", "w")
    held = sparse.unit_weights(i, "id").selectExpr("id AS i", "term", "w AS v")
    terms = sparse.with_reach(asked, held, sparse.lower_bounds(asked, held, 1))
    met = terms.where("needed").join(held, "term").select("q", "i").distinct().count()
    assert met <= 2 * 20
    got = sparse.nearest_by_terms(q, i, 1, "id", "id").collect()
    assert sorted((r[0], r[2]) for r in got) == [(n, n) for n in range(20)]


def test_only_terms_that_are_asked_for_are_kept_of_the_items(spark, monkeypatch):
    """Lengths are of whole texts all the same."""
    kept, cut = [], sparse.cut

    def watched(df):
        made = cut(df)
        kept.append((made.columns, made))
        return made

    monkeypatch.setattr(sparse, "cut", watched)
    items = spark.createDataFrame(
        [(i, t, 1.0) for i in range(20) for t in ("a", "b", f"own {i}", f"more {i}")], "id bigint, term string, weight double")
    queries = spark.createDataFrame([(7, "own 3", 2.0), (7, "absent", 2.0)], "id bigint, term string, weight double")
    got = sparse.nearest_by_terms(queries, items, 2, "id", "id").collect()
    assert [(r[0], r[1], r[2], round(r[3], 9)) for r in got] == [(7, 1, 3, round(0.5 / 2 ** 0.5, 9))]
    held = [made.count() for names, made in kept if names == ["i", "term", "v"]]
    assert held == [1]
