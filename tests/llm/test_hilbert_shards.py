from collections import defaultdict
from itertools import product

import pytest
from edge_cases import edge_rows
from pyspark.sql import functions as F

from rollmatch.llm import hilbert_shards as H


def curve(point, dims, bits):
    names = {f"x{i}": v for i, v in enumerate(point)}
    for step in H.hilbert_steps(dims, bits):
        new = {}
        for name, text in step.items():
            text = text.replace("<>", "!=").replace("CASE WHEN", "(1 and [").replace("THEN", ",").replace("ELSE", ",")
            new[name] = _value(text, names)
        names.update(new)
    return names["h"]


def _value(text, names):
    import re
    while "END" in text:
        text = re.sub(r"\(1 and \[((?:(?!\(1 and \[).)*?),((?:(?!\(1 and \[).)*?),((?:(?!\(1 and \[).)*?)END",
                      r"((\2) if (\1) else (\3))", text, count=1)
    return eval(text, {}, names)  # noqa: S307 (text made by the module under test)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4)])
def test_curve_visits_neighbouring_cells(dims, bits):
    order = {curve(p, dims, bits): p for p in product(range(1 << bits), repeat=dims)}
    assert sorted(order) == list(range(1 << (bits * dims)))
    for i in range(len(order) - 1):
        assert sum(abs(a - b) for a, b in zip(order[i], order[i + 1])) == 1


def placed(df, shards=16):
    return H.assign(df, [H.name_code(F.col("lang")), H.name_code(F.col("source")), H.size_code(F.col("n_chars"))],
                    [F.col("doc_id"), F.col("text")], shards)


@pytest.mark.parametrize("rows_per_slice", [16384, 3])
def test_shards_differ_by_one_row_and_slots_have_no_gap(edge, monkeypatch, rows_per_slice):
    monkeypatch.setattr(H, "SLICE_ROWS", rows_per_slice)
    slots = defaultdict(list)
    for r in placed(edge).select("shard", "slot").collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == len(edge_rows()) and set(slots) == set(range(16))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_order_follows_the_curve(edge):
    rows = placed(edge).select("shard", "slot", "lang", "source", "n_chars", H.name_code(F.col("lang")).alias("a"),
                               H.name_code(F.col("source")).alias("b"), H.size_code(F.col("n_chars")).alias("c")).collect()
    along = [curve((r.a, r.b, r.c), 3, H.BITS) for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert along == sorted(along)


def test_few_rows_and_none(edge, empty, tmp_path):
    assert {r.slot for r in placed(edge.limit(3)).collect()} == {0}
    out = placed(empty)
    assert out.count() == 0 and "odd name." in out.columns
    H.write_shards(placed(edge), str(tmp_path / "s"))
    assert edge.sparkSession.read.parquet(str(tmp_path / "s")).count() == len(edge_rows())
