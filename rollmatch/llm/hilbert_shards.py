"""Sharding along a Hilbert curve. DataFrame functions only.

Metadata columns are quantised to a few bits each, a row's cell is numbered along the Hilbert curve through all cells,
and the rows in curve order are cut into runs whose row counts differ by at most one. Rows near each other in
several columns lie in the same files, so minimum and maximum per file prune on any of them.

Nothing is sorted as a whole: a row's rank is the count of rows in earlier cells, plus the count in earlier slices of
its own cell, plus its place in its slice. A slice is a range of hash values that holds some SLICE_ROWS rows,
so a cell with a third of all rows is many small windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.llm.common import nested, unnested
from rollmatch.session import cut

BITS = 4            # per dimension: three dimensions make 4,096 cells
SLICE_ROWS = 16384
SLICES = 65536      # at most, from four hexadecimal digits of a digest


def name_code(value: Column, bits: int = BITS) -> Column:
    """A name's place on an axis: the leading bits of its digest; null has that of an empty name."""
    return (F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 4), 16, 10).cast("int")
            / 2 ** (16 - bits)).cast("int")


def size_code(value: Column, bits: int = BITS) -> Column:
    """A size's place on an axis: the number of its binary digits, at most 2^bits - 1; null is 0."""
    return F.least(F.length(F.bin(F.coalesce(value.cast("long"), F.lit(0)))), F.lit(2 ** bits - 1))


def hilbert_steps(dims: int, bits: int) -> list[dict[str, str]]:
    """Assignments, one set after the other, that turn columns x0, x1, ... into `h`, the index along the curve.

    The axes are turned into the transposed index (exchange or invert low bits from the top bit down, then Gray
    encode), whose bits are then interleaved. The text is plain SQL arithmetic on whole numbers.
    """
    def flip(a: str, b: str) -> str:  # exclusive or by sums, so that any SQL engine reads it
        return f"({a} + {b} - 2 * ({a} & {b}))"

    steps: list[dict[str, str]] = []
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for i in range(dims):
            if i == 0:
                steps.append({"x0": f"CASE WHEN (x0 & {q}) <> 0 THEN {flip('x0', str(q - 1))} ELSE x0 END"})
                continue
            swap = f"({flip('x0', f'x{i}')} & {q - 1})"
            steps.append({"s": swap})
            steps.append({"x0": f"CASE WHEN (x{i} & {q}) <> 0 THEN {flip('x0', str(q - 1))} ELSE {flip('x0', 's')} END",
                          f"x{i}": f"CASE WHEN (x{i} & {q}) <> 0 THEN x{i} ELSE {flip(f'x{i}', 's')} END"})
    for i in range(1, dims):
        steps.append({f"x{i}": flip(f"x{i}", f"x{i - 1}")})
    steps.append({"g": "0"})
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        steps.append({"g": f"CASE WHEN (x{dims - 1} & {q}) <> 0 THEN {flip('g', str(q - 1))} ELSE g END"})
    steps.append({f"x{i}": flip(f"x{i}", "g") for i in range(dims)})
    digits = [f"CASE WHEN (x{i} & {1 << level}) <> 0 THEN {1 << (level * dims + dims - 1 - i)} ELSE 0 END"
              for level in range(bits) for i in range(dims)]
    steps.append({"h": " + ".join(digits)})
    return steps


def _curve(cells: DataFrame, dims: int) -> DataFrame:
    """`h` for each distinct cell; the columns c0, c1, ... stay."""
    df = cells.withColumns({f"x{i}": F.col(f"c{i}") for i in range(dims)})
    for step in hilbert_steps(dims, BITS):
        df = df.withColumns({name: F.expr(value) for name, value in step.items()})
    return df.drop("s", "g", *[f"x{i}" for i in range(dims)])


def assign(docs: DataFrame, axes: Sequence[Column], tie: Sequence[Column], shards: int = 16) -> DataFrame:
    """Every input row with shard (int, 0 to shards - 1) and slot (long, gapless from 0 in its shard, in curve order).

    axes: columns of whole numbers from 0 to 2^BITS - 1. tie: columns that tell rows of one cell apart. Rows equal in
    all of them (repeated rows) are exchangeable: any of them may take any of their places. Fewer rows than shards
    leave some shards empty. Result columns replace those of the same name; an empty table gives none.
    """
    dims = len(axes)
    digest = F.md5(F.concat_ws("|", *[F.coalesce(t.cast("string"), F.lit("")) for t in tie]))
    rows = cut(nested(docs, **{f"c{i}": a.cast("int") for i, a in enumerate(axes)}, tie=digest))
    n = rows.count()
    slices = min(SLICES, max(1, -(-n // SLICE_ROWS)))
    rows = rows.withColumn("slice", (F.conv(F.substring("tie", 1, 4), 16, 10).cast("long") * slices / SLICES).cast("int"))
    cell = [f"c{i}" for i in range(dims)]
    counts = rows.groupBy(*cell, "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*cell).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("in_cell", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # At most 2^(dims * BITS) rows, whatever the number of documents: one window may see them all.
    cells = _curve(counts.groupBy(*cell).agg(F.sum("n").alias("n")), dims)
    cells = cells.select(*cell, F.coalesce(F.sum("n").over(
        Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("in_earlier"))
    starts = counts.join(F.broadcast(cells), cell).select(*cell, "slice",
                                                          (F.col("in_cell") + F.col("in_earlier")).alias("start"))
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy(*cell, "slice").orderBy("tie")))
    rank = placed.join(starts, [*cell, "slice"]).withColumn("rank", F.col("start") + F.col("place") - 1)
    shard = F.expr(f"rank * {shards} div {n or 1}")
    first = F.expr(f"({n} * shard + {shards - 1}) div {shards}")
    out = rank.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("rank") - first).cast("long"))
    return unnested(out, "shard", "slot")


def write_shards(assigned: DataFrame, path: str, shards: int = 16) -> None:
    """One folder per shard, its rows in slot order; one file each, or more if the writer splits them by size."""
    (assigned.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
