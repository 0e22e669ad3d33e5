import random
from collections import defaultdict

import numpy as np
import pytest
from edge_cases import edge_rows, prose

from rollmatch.llm import near_dedup as N
from rollmatch.llm.components import components
from rollmatch.llm.shingles import sets


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(n_shingles, component_id) per row, from all pairs."""
    found, root = [shingle_set(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if both and 100 * both >= 75 * (len(found[i]) + len(found[j]) - both):
                root[top(i)] = top(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[top(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(len(found[i]), least[top(i)]) for i in range(len(rows))]


def check(df, rows):
    got = N.near_groups(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((r[0], *b)) for r, b in zip(rows, brute(rows)))


def copies(n, words=120):
    """A group whose members differ from one text in a few words, some in many, and unrelated texts."""
    rng = random.Random(n)
    first = prose(rng, words).split()
    rows = []
    for i in range(n):
        w = list(first)
        for _ in range(rng.choice((1, 1, 2, 4, 6))):
            w[rng.randrange(words)] = f"new{i}x{rng.randrange(9)}"
        rows.append((1000 - i, " ".join(w)))
    return rows + [(2000 + i, prose(rng, words)) for i in range(10)]


def test_sets_are_the_distinct_shingles():
    texts = [r[1] for r in edge_rows()]
    for text, found in zip(texts, sets(texts)):
        assert len(found) == len(shingle_set(text)) and (np.diff(found.astype(object)) > 0).all()
    a, b = sets(["A b C d e f", "x a B c D e F"])
    assert len(np.intersect1d(a, b)) == 2


def test_edge_cases_match_brute_force(edge, empty):
    check(edge, [r[:2] for r in edge_rows()])
    assert N.near_groups(empty).count() == 0 and N.keep_one(empty).count() == 0


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 12}, {"POSTING": 5, "BLOCK": 12}, {"TASK_BYTES": 4096}])
def test_large_groups_match_brute_force(table, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(N, name, value)
    rows = copies(60)
    check(table(rows, "doc_id long, text string"), rows)


def test_keep_one_of_each_group(edge):
    kept = N.keep_one(edge)
    assert kept.schema == edge.schema
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 0 and ids.count(7) == 1 and ids.count(13) == 1 and 9 not in ids and ids.count(2) == 1
    same = edge.filter("doc_id = 8").unionByName(edge.filter("doc_id = 8"))
    assert N.keep_one(same).count() == 1


def test_spanning_reaches_whole_components():
    rng = np.random.default_rng(2)
    near = rng.random((40, 40)) < 0.03
    near |= near.T
    edges = list(N.spanning(40, lambda i, others: near[i, others]))
    root = list(range(40))
    for a, b in edges:
        assert near[a, b]
        root = [root[a] if r == root[b] else r for r in root]
    assert all(root[a] == root[b] for a in range(40) for b in range(40) if near[a, b])


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 150), (150, 120)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(51)} == {0} and {got[i] for i in (120, 139, 150, 200)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
