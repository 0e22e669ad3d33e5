from collections import defaultdict

import numpy as np
from edge_cases import edge_rows

from rollmatch.llm import mixing as M


def test_targets_share_the_excess_by_weight():
    assert M.targets([10, 10, 10], [1, 1, 1]) == [10, 10, 10]
    got = M.targets([1, 100, 100], [5, 2, 1])
    assert got[0] == 3 and abs(sum(got) - 201) < 1e-9 and abs(got[1] / got[2] - 2) < 1e-9
    assert M.targets([0, 5], [5, 1]) == [0, 5]
    assert M.targets([], []) == []


def test_settle_keeps_the_sum_of_words_and_the_expectation():
    rng = np.random.default_rng(3)
    words, parts = np.sort(rng.integers(1, 900, 40))[::-1].astype(float), rng.random(40)
    total = np.zeros(40)
    for _ in range(3000):
        out, held = M.settle(parts, words, rng.random(40))
        assert abs((out * words).sum() - (parts * words).sum()) < 1e-6
        assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != held)
        total += out
    assert np.abs(total / 3000 - parts).max() < 0.05


def test_mix_comes_near_its_targets_and_reruns_agree(spark, edge, empty, monkeypatch):
    monkeypatch.setattr(M, "LEAF_ROWS", 4)
    monkeypatch.setattr(M, "FAN_IN", 2)
    plan = M.plan_mix(edge)
    got = plan.select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    assert len(got) == len(edge_rows())
    assert sorted(map(str, got)) == sorted(map(str, M.plan_mix(edge.repartition(5)).select(*got[0].__fields__).collect()))
    taken, most, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
        most[r.source] = max(most[r.source], r.size)
        target[r.source] = r.target
    assert set(taken) == {"a", "b", "", "c", None}
    for source in taken:
        assert abs(taken[source] - target[source]) <= most[source]
    again = M.mix(edge)
    assert again.columns == edge.columns and again.count() == sum(r.copies for r in got)
    assert M.mix(empty).count() == 0 and M.plan_mix(empty).count() == 0


def test_repeated_rows_are_rounded_one_by_one(spark, table):
    rows = [(1, "a b c d", "s")] * 20 + [(2, "x " * 80, "t")]
    got = M.plan_mix(table(rows, "doc_id long, text string, source string")).filter("source = 's'").collect()
    assert abs(sum(r.copies * 4 for r in got) - got[0].target) <= 4
