import random

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from rollmatch.operators import order


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_id", "user_id", "CASE WHEN value > 60 THEN event_type END AS kind",
        "CASE WHEN value > 100 THEN props END AS note").cache()


@pytest.mark.parametrize("partitions", [None, 1, 7, 64])
@pytest.mark.parametrize("within", [(), ("user_id",)])
def test_fill_over_partitions_equals_global_window(events, partitions, within):
    w = Window.partitionBy(*within).orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    want = events.select("event_id", "user_id", *[F.last(c, ignorenulls=True).over(w).alias(c) for c in ("kind", "note")])
    got = order.fill_down(events, ["kind", "note"], "event_id", within, partitions)
    assert rows(got) == rows(want)


def test_a_third_of_the_rows_under_one_key(spark):
    skewed = spark.range(9000).selectExpr(
        "id", "IF(id < 3000, 0, id) AS k", "IF(id % 50 = 0, CAST(id AS STRING), NULL) AS v")
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("v", F.last("v", ignorenulls=True).over(w))
    assert rows(order.fill_down(skewed, ["v"], "id", ["k"], partitions=30)) == rows(want)


def test_null_key_is_a_key_of_its_own(table):
    df = table([(1, None, "a"), (2, "k", "b"), (3, None, None), (4, "k", None)], "o int, k string, v string")
    assert rows(order.fill_down(df, ["v"], "o", ["k"], partitions=3), "o", "v") == [(1, "a"), (2, "b"), (3, "a"), (4, "b")]


def test_absent_columns_are_ignored(table):
    df = table([(1, "a")], "_ord int, v string")
    assert order.fill_down(df, ["nope"]) is df


@pytest.mark.parametrize("partitions", [1, 10, 100])
def test_row_numbers_have_no_gaps(spark, partitions):
    sparse = spark.range(0, 5000, 7).withColumnRenamed("id", "_ord")
    got = rows(order.number_rows(sparse, "n", start=1, partitions=partitions), "_ord", "n")
    assert sorted(got) == [(7 * i, i + 1) for i in range(len(range(0, 5000, 7)))]


def test_file_order_over_files_and_splits(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 40)}" for i in range(3000)]
    for part, low in enumerate(range(0, 3000, 1000)):
        (tmp_path / f"part-{part}.csv").write_text("n,pad\n" + "\n".join(lines[low:low + 1000]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = order.with_file_order(spark.read.csv(str(tmp_path), header=True))
        got = sorted((r["_ord"], int(r["n"])) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, i) for i in range(3000)]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(500)
    one, two = (rows(order.sample_rows(df.repartition(n), 25, "id", seed=3)) for n in (2, 7))
    assert len(one) == 25 and one == two
    assert one != rows(order.sample_rows(df, 25, "id", seed=4))


@pytest.mark.parametrize("within", [(), ("k",)])
@pytest.mark.parametrize("gap", [1_000_003, 1 << 49])
def test_values_far_apart(spark, within, gap):
    sparse = spark.range(3000).selectExpr(
        f"(id - 1500) * {gap} AS o", "id % 7 AS k", "IF(id % 50 = 3, CAST(id AS STRING), NULL) AS v")
    w = Window.partitionBy(*within).orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(order.fill_down(sparse, ["v"], "o", within)) == rows(
        sparse.withColumn("v", F.last("v", ignorenulls=True).over(w)))
    numbered = order.number_rows(sparse, "n", "o").orderBy("o").select("n").collect()
    assert [r.n for r in numbered] == list(range(3000))


def test_one_key_over_many_partitions_without_values(table):
    """What a partition hands on may come from several partitions before it, and stops at the next key."""
    data = [(i, "a" if i < 40 else "b" if i < 45 else None, "first" if i == 3 else "late" if i == 50 else None) for i in range(60)]
    df = table(data, "o int, k string, v string")
    got = dict(rows(order.fill_down(df, ["v"], "o", ["k"], partitions=20), "o", "v"))
    assert got == {i: "first" if 3 <= i < 40 else "late" if i >= 50 else None for i in range(60)}
    assert order.fill_down(df.limit(0), ["v"], "o", ["k"]).count() == 0


@pytest.mark.parametrize("within", [(), ("k",)])
def test_two_exchanges_of_full_length(spark, monkeypatch, within):
    """Rows are dealt out by range once, written, and met once more by the number of their partition."""
    written = []
    whole = order.cut
    monkeypatch.setattr(order, "cut", lambda df: written.append(df) or whole(df))
    sparse = spark.range(20000).selectExpr("id * 1000003 AS o", "id % 3 AS k", "CAST(id AS STRING) AS v")
    filled = order.fill_down(sparse, ["v"], "o", within, partitions=16)
    assert filled.count() == 20000 and len(written) == 1
    dealt = written[0]._jdf.queryExecution().executedPlan().toString()
    assert dealt.count("Exchange") == dealt.count("rangepartitioning") == 1
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the summary were large
    try:
        plan = order.fill_down(sparse, ["v"], "o", within, partitions=16)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("REPARTITION_BY_NUM") == 1
    # All other exchanges are behind the sums per partition.
    first = plan.index("REPARTITION_BY_NUM")
    assert "Aggregate" not in plan[:first] and plan[:first].count("Exchange") == 1
    assert plan[first:].index("Exchange") < plan[first:].rindex("Aggregate")


@pytest.mark.parametrize("n", [1, 100, 333, 999, 1000, 5000])
def test_lowest_rows_are_counted_off(spark, n):
    """Values of both signs and far apart, ties at the end, more rows asked for than there are."""
    rng = random.Random(n)
    data = [(rng.choice((-(1 << 63), -5, 0, 7, (1 << 63) - 1, rng.randrange(-(1 << 62), 1 << 62))), i) for i in range(1000)]
    df = spark.createDataFrame(data, "v long, t int")
    found = order.lowest_rows(df, n, F.col("v"), F.col("t"), few=0)
    assert sorted(map(tuple, found.collect())) == sorted(data)[:n]
    assert sorted(map(tuple, order.lowest_rows(df, n, F.col("v"), F.col("t")).collect())) == sorted(data)[:n]


def test_many_rows_are_drawn_without_a_sort(spark, tmp_path):
    spark.range(9000).selectExpr("id", "id % 1000 AS k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    for found in (order.sample_rows(df, 3000, "id", few=0), order.lowest_rows(df, 3000, F.col("id"), F.lit(0), few=0)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 3000 and "TakeOrdered" not in plan and "Exchange" not in plan and "Sort" not in plan
    assert order.sample_rows(df, 3001, "k", few=0).count() == 3001  # keys of nine rows each
    again = [sorted(r.id for r in order.sample_rows(df.repartition(p), 3000, "id", few=0).collect()) for p in (2, 5)]
    assert again[0] == again[1] and len(set(again[0])) == 3000


def test_one_exchange_and_no_write_for_row_numbers(spark, monkeypatch):
    """Order values close together: each row tells its range, so the table is dealt out once, to its window."""
    monkeypatch.setattr(order, "cut", lambda df: 1 / 0)
    close = spark.range(20000).selectExpr("id * 3 - 70 AS o", "IF(id % 90 = 5, CAST(id AS STRING), NULL) AS v")
    w = Window.partitionBy(F.lit(0)).orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    filled = order.fill_down(close, ["v"], "o", partitions=16)
    assert rows(filled) == rows(close.withColumn("v", F.last("v", ignorenulls=True).over(w)))
    numbered = order.number_rows(close, "n", "o", partitions=16)
    assert [r.n for r in numbered.orderBy("o").select("n").collect()] == list(range(20000))
    for made in (filled, numbered):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1
