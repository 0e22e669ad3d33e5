import pytest
from helpers import rows
from pyspark.sql import functions as F

from rollmatch.operators import dedupe, rollup
from rollmatch.operators.order import fill_down

EXPORT = [
    (0, None, "early", "lost"), (1, "A", None, "x"), (2, None, None, "NA"), (3, "", "m", None), (4, "B", None, "<NA>"),
    (5, None, "f", None), (6, "A", "f", "y/-/z"), (7, None, None, "nan"),
]
SCHEMA = "_ord int, id string, sex string, job string"


@pytest.fixture
def export(table):
    return table(EXPORT, SCHEMA)


def record_fill(rows_in):
    """Row-by-row copy of cells from the latest keyed row."""
    head, out = None, []
    for _, key, *cells in rows_in:
        row = [key, *cells]
        if key not in (None, ""):
            head = row
        elif head is not None:
            row = [h if c in (None, "") else c for c, h in zip(row, head)]
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("block", [1, 3, 100])
def test_fill_records(export, block):
    got = rollup.fill_records(export, "id", dedupe=False, partitions=block)
    assert [tuple(r)[1:] for r in got.orderBy("_ord").collect()] == record_fill(EXPORT)
    assert rows(rollup.fill_records(export, "id", partitions=block)) == sorted(set(record_fill(EXPORT)), key=str)


def test_fill_records_moves_no_rows_where_nothing_is_taken(spark, table):
    filled = table([(1, None, "x"), (2, "a", None), (3, "a", ""), (4, "b", "y")], "_ord long, id string, v string")
    made = rollup.fill_records(filled, "id", dedupe=False)
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    assert rows(made) == rows(filled)
    # A keyless row after a keyed one, or a row without a place, and the values are carried.
    for more in ([(5, "", "")], [(5, None, None)]):
        wanted = rollup.fill_records(filled.union(table(more, filled.schema)), "id", dedupe=False)
        assert ("b", "y") in rows(wanted.where("_ord = 5"), "id", "v")
    assert "Window" in rollup.fill_records(filled.union(table([(None, "c", "z")], filled.schema)), "id")._jdf.queryExecution().toString()


def test_fill_down_leaks_across_records_unless_kept_within(export):
    keyed = fill_down(rollup.null_tokens(export, ("",)), ["id"])
    leaky = {r["_ord"]: r["sex"] for r in fill_down(keyed, ["sex"]).collect()}
    kept = {r["_ord"]: r["sex"] for r in fill_down(keyed, ["sex"], within=["id"]).collect()}
    assert leaky[1] == "early" and leaky[4] == "m"
    assert kept[1] is None and kept[4] is None


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_concat_rows(export, block):
    keyed = fill_down(rollup.null_tokens(export, ("",)), ["id"])
    got = rollup.concat_rows(keyed, ["id"], ["job", "sex"], block=block)
    assert rows(got, "id", "job", "sex") == [("A", "x,y/-/z,nan", "m,f"), ("B", "", "f"), (None, "lost", "early")]


def test_pieces_join_to_the_whole(export):
    keyed = fill_down(rollup.null_tokens(export, ("",)), ["id"])
    pieces = rollup.concat_pieces(keyed, ["id"], ["job"], block=2).where("job IS NOT NULL").orderBy("piece").collect()
    assert ",".join(p["job"] for p in pieces if p["id"] == "A") == "x,y/-/z,nan"


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_roll_up_lists(export, block):
    got = rollup.roll_up_lists(rollup.null_tokens(export, ("",)), ["id", "sex"], ["job"], "id", block=block)
    assert rows(got) == [
        ("A", "NA", ["x", "NA", "y", "z"]), ("B", "NA", ["<NA>"]), (None, "early", None)]


def test_key_must_be_filled(export):
    with pytest.raises(ValueError):
        rollup.roll_up_lists(export, ["sex"], ["job"], "id")


def test_empty_group_is_a_list_of_one_empty_text(table):
    df = table([(1, "A", None), (2, "B", "v")], "_ord int, k string, v string")
    assert rows(rollup.collect_rows(df, ["k"], ["v"])) == [("A", [""]), ("B", ["v"])]


@pytest.mark.parametrize("block", [1, 1000])
def test_roll_up_text_keeps_the_first_row(export, block):
    clean = rollup.null_tokens(export, ("",))
    got = rollup.roll_up_text(clean, ["id"], ["job"], ["id", "sex", "job"], "id", block=block)
    assert rows(got) == [("A", None, "x,y/-/z,nan"), ("B", None, ""), (None, "early", None)]


def test_one_row_per_key_and_hot_key_survives(spark):
    df = spark.range(6000).selectExpr("id AS _ord", "IF(id < 2000, 'hot', CAST(id AS STRING)) AS k", "CAST(id AS STRING) AS v")
    got = rollup.concat_rows(df, ["k"], ["v"], block=64)
    assert got.count() == 4001
    assert got.where("k = 'hot'").first()["v"] == ",".join(map(str, range(2000)))


def test_last_answer_wins_even_when_null(table):
    df = table([(1, "A", "work", "old"), (2, "A", "work", None), (3, "A", "other", "z"), (4, "B", "work", "b"), (5, None, "work", "n")],
               "_ord int, k string, q string, v string")
    got = rollup.attach_last_answers(df, "k", "q", {"w": ("work", "v"), "o": ("other", "v")})
    assert rows(got, "_ord", "w", "o") == [
        (1, None, "z"), (2, None, "z"), (3, None, "z"), (4, "b", None), (5, None, None)]
    picks = rollup.last_answers("q", {"w": ("work", "v")})
    rolled = rollup.roll_up_text(df, (), [], ["k"], "k", feedback=picks)
    assert rows(rolled) == [("A", None), ("B", "b"), (None, None)]


def test_keep_first_and_last_with_null_keys(table):
    df = table([(1, None, "a"), (2, None, "b"), (3, "k", "c"), (4, "k", None)], "_ord int, k string, v string")
    assert rows(dedupe.keep_first(df, ["k"])) == [(1, None, "a"), (3, "k", "c")]
    assert rows(dedupe.keep_last(df, ["k", "absent"])) == [(2, None, "b"), (4, "k", None)]
    assert dedupe.keep_last(df, ["absent"]) is df


def test_count_report(table):
    one, two = table([("a",), ("b",)], "k string"), table([("b",), ("c",), ("c",), (None,)], "k string")
    got = rollup.count_report(one, two.where("k = 'c'"), two, "k")
    assert rows(got) == [(2, 2, 4, 2)]
    empty = one.where(F.lit(False))
    assert rows(rollup.count_report(empty, empty, empty, "k")) == [(0, 0, 0, 0)]


def test_items_are_the_lists_and_no_cell_is_long(spark, monkeypatch):
    """A record of 30,000 rows among short ones: the same lists, from pieces of at most one block of rows."""
    df = spark.range(30100).selectExpr(
        "id AS _ord", "CASE WHEN id < 3 THEN NULL WHEN id < 30003 THEN IF(id = 3, 'big', NULL) WHEN id % 10 = 3 THEN concat('k', id) END AS k",
        "IF(id % 7 = 0, NULL, IF(id % 11 = 0, concat('a', id, '/-/b'), CAST(id AS STRING))) AS v", "IF(id > 30050, 'x', NULL) AS w")
    longest = []
    whole = rollup.cut
    monkeypatch.setattr(rollup, "cut", lambda d: longest.append(d) or whole(d))
    records, items = rollup.roll_up_items(df, ["k"], ["v", "w"], "k", block=1000)
    got = {}
    for r in items.collect():
        got.setdefault((r["k"], r["name"]), []).append((r["at"], r["value"]))
    lists = {r["k"]: r for r in rollup.roll_up_lists(df, ["k"], ["v", "w"], "k").collect()}
    assert rows(records, "k") == sorted([(k,) for k in lists], key=str)
    assert None in lists and {k for k, _ in got} == set(lists) - {None}
    for (k, name), held in got.items():
        assert sorted(held) == list(enumerate(lists[k][name]))
    pieces = next(d for d in longest if "piece" in d.columns)
    assert pieces.selectExpr("max(size(v))").first()[0] <= 2 * 1000 and len(lists["big"]["v"]) > 25000
