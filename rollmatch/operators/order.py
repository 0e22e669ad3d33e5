"""Operators that depend on row order, without sorting the whole table in one task.

Rows carry a unique integer order column. The table is dealt out once by ranges of (key, order), whatever the values look
like, and each partition knows its place. What a partition needs from the ones before it (the last value
seen, the number of rows) is found on one summary row per partition; then one window per partition applies it. A key with
a third of all rows lies in as many partitions as its rows fill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols, listed, quoted
from rollmatch.session import cut

ORDER = "_ord"
BLOCK = 1 << 13     # consecutive order values combined into one piece, see rollup
PART = "__part"
CLOSE = 4           # order values per row, on average, up to which ranges of equal width are even enough
FEW = 100_000       # rows that a sort with a limit may bring to one task


def _over(keys: Sequence[str], order: str, end: str) -> str:
    parts = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"OVER ({parts}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"


def _ranged(df: DataFrame, keys: Sequence[str], order: str, partitions: int | None) -> tuple[DataFrame, int]:
    """The rows with the number of the range of (keys, order) they are in, and the number of ranges.

    Order values that lie close together, as row numbers do, are divided into ranges of equal width, which a row finds by
    itself. Others are dealt out by Spark's sampled ranges and written: only the written numbers count afterwards, so it
    does not matter how often that sample is drawn.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        low, high, count = df.agg(F.min(col(order)), F.max(col(order)), F.count(F.lit(1))).first()
        if count and high - low < CLOSE * count:
            width = (high - low) // n + 1
            return df.withColumn(PART, F.expr(f"CAST((CAST({quoted(order)} AS BIGINT) - {low}L) div {width}L AS INT)")), n
    dealt = df.repartitionByRange(n, *[col(k) for k in keys], col(order))
    return cut(dealt.withColumn(PART, F.spark_partition_id())), n


def carry(
    df: DataFrame,
    values: Mapping[str, str],
    order: str = ORDER,
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add, per entry of `values` (name: SQL expression), its last non-null value at or before the row.

    With `within`, the search stays inside rows of equal key (null is a key of its own).
    """
    names = [f"__v{i}" for i in range(len(values))]
    tagged = df.selectExpr(*cols(df.columns), *[f"{expr} AS {n}" for n, expr in zip(names, values.values())])
    ranged, n = _ranged(tagged, within, order, partitions)
    key, at = f"struct({listed(within) or '0'})", quoted(order)
    # A partition's rows of its last key go on in the next one: their last values, if that key has any.
    ends = ranged.groupBy(PART).agg(F.expr(f"min({key}) AS __first"), F.expr(f"max({key}) AS __last"), *[F.expr(
        f"max_by(struct({key} AS k, {v} AS v), CASE WHEN {v} IS NOT NULL THEN struct({key}, {at}) END) AS {v}") for v in names])
    seen = ends.selectExpr(PART, "__first", "__last", *[
        f"last(CASE WHEN {v}.k <=> __last THEN {v}.v END, true) {_over(['__last'], PART, 'CURRENT ROW')} AS {v}" for v in names])
    before = seen.selectExpr(PART, "__first", *[
        f"CASE WHEN lag(__last) OVER (ORDER BY {PART}) <=> __first THEN lag({v}) OVER (ORDER BY {PART}) END AS {v}_in" for v in names])
    inside = _over([PART, *cols(within)], at, "CURRENT ROW")
    filled = ranged.repartition(n, PART).selectExpr(
        *cols(df.columns), PART, *[f"last({v}, true) {inside} AS {v}" for v in names])
    return filled.join(before, PART).selectExpr(
        *cols(c for c in df.columns if c not in values),
        *[f"coalesce({v}, CASE WHEN {key} <=> __first THEN {v}_in END) AS {quoted(out)}" for v, out in zip(names, values)])


def fill_down(
    df: DataFrame,
    columns: Sequence[str],
    order: str = ORDER,
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Forward fill; columns the table lacks are ignored."""
    present = [c for c in columns if c in df.columns and c not in within]
    if not present:
        return df
    return carry(df, {c: quoted(c) for c in present}, order, within, partitions).select(*cols(df.columns))


def number_rows(df: DataFrame, name: str, order: str = ORDER, start: int = 0, partitions: int | None = None) -> DataFrame:
    """Gap-free row number in the order of a unique integer column."""
    ranged, n = _ranged(df, (), order, partitions)
    sizes = ranged.groupBy(PART).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.selectExpr(PART, f"coalesce(sum(__n) {_over([], PART, '1 PRECEDING')}, 0) AS __before")
    inside = Window.partitionBy(PART).orderBy(col(order))
    placed = ranged.repartition(n, PART).withColumn("__k", F.row_number().over(inside)).join(before, PART)
    return placed.select(*cols(df.columns), (F.col("__before") + F.col("__k") - 1 + F.lit(start)).cast("long").alias(name))


def with_file_order(df: DataFrame, name: str = ORDER) -> DataFrame:
    """Row number in file order for a table read straight from files.

    The row id of a scan counts within a task, and tasks pack splits by size; so rows are counted per split
    and the splits are put in order of file and offset.
    """
    file, start, here = "__file", "__start", "__here"
    tagged = df.select(
        *cols(df.columns),
        F.col("_metadata.file_path").alias(file),
        F.col("_metadata.file_block_start").alias(start),
        F.monotonically_increasing_id().alias(here),
    )
    splits = tagged.groupBy(file, start).agg(F.count(F.lit(1)).alias("__n"), F.min(here).alias("__low"))
    files = splits.groupBy(file).agg(F.sum("__n").alias("__all"))
    # Running totals over files, then over the splits of each file: both tables hold one row per file or split.
    over_files = Window.partitionBy(F.lit(0)).orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(file, F.coalesce(F.sum("__all").over(over_files), F.lit(0)).alias("__files_before"))
    over_splits = Window.partitionBy(file).orderBy(start).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select(
        file, start, "__low", F.coalesce(F.sum("__n").over(over_splits), F.lit(0)).alias("__splits_before"))
    offsets = splits.join(files, file).select(
        file, start, (F.col("__files_before") + F.col("__splits_before") - F.col("__low")).alias("__offset"))
    return tagged.join(offsets, [file, start]).select(
        *cols(df.columns), (F.col("__offset") + F.col(here)).alias(name))


def lowest_rows(df: DataFrame, n: int, value: Column, tie: Column, few: int = FEW) -> DataFrame:
    """Exactly the n rows of the lowest values (64-bit integers); of equal values those that `tie` puts first.

    Up to `few` rows are kept by a sort with a limit, which brings them to one task. More are cut off at the n-th value, which
    is found by counting: rows per leading 16 bits, then per next 16 bits of those that share the bits found so far. At most
    four counts of one column, of at most 65,536 groups each; the rows themselves are only filtered. `df` is read several times
    and has to be the same each time, so it comes from files. A row without a value is not among them.
    """
    if n <= few:
        return df.orderBy(value, tie).limit(n)
    # Unsigned order: the sign bit turned round.
    value = value.cast("long")
    bits = value.bitwiseXOR(F.lit(-(1 << 63)))
    low, left, within = 0, n, value.isNotNull()
    for shift in (48, 32, 16, 0):
        counted = df.where(within).groupBy(F.shiftrightunsigned(bits, shift).bitwiseAND(0xFFFF).alias("digit")).agg(
            F.count(F.lit(1)).alias("n")).collect()
        for digit, count in sorted((r["digit"], r["n"]) for r in counted):
            if count >= left:
                break
            left -= count
        else:
            return df.where(value.isNotNull())  # no more than n rows
        low += digit << shift
        first, last = (x - (1 << 63) for x in (low, low + (1 << shift) - 1))
        within = value.between(F.lit(first), F.lit(last))
        if count == left:
            return df.where(value <= F.lit(last))
    return df.where(value < F.lit(first)).unionByName(df.where(within).orderBy(tie).limit(left))


def first_rows(df: DataFrame, n: int, order: str = ORDER) -> DataFrame:
    """The first n rows in row order."""
    return lowest_rows(df, n, col(order), col(order))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0, few: int = FEW) -> DataFrame:
    """Exactly n rows drawn without replacement.

    The draw ranks rows by a seeded hash of a unique key, so a re-run of a lost task draws the same rows.
    """
    return lowest_rows(df, n, F.xxhash64(F.lit(seed), col(key)), col(key), few)
