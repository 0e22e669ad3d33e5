"""Reading spreadsheet tabs and CSV files."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmatch.functions.columns import col
from rollmatch.functions.nulls import CSV_TOKENS, TAB_TOKENS, null_tokens
from rollmatch.operators.order import ORDER, with_file_order
from rollmatch.session import cut
from rollmatch.sources.versions import current_path, path_exists

# Quoting in which a cell may hold commas, doubled quotes and line breaks.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


# A cell of either token is null as it is parsed; an empty cell reads as the other token first.
TAB_NULLS = {"nullValue": TAB_TOKENS[1], "emptyValue": TAB_TOKENS[1]}
MARKS = {"odd": pa.int64(), "blank": pa.bool_(), "open": pa.int64(), "n0": pa.int64(), "n1": pa.int64()}
MARKED = "file string, start long, line long, odd long, blank boolean, open long, n0 long, n1 long"


def _marked(batches: Iterable[pa.RecordBatch], values: bool) -> Iterator[pa.RecordBatch]:
    """Lines of a task, in file order, with the running counts of their split; a task may hold several splits one after another."""
    last, odds, begun = None, 0, [0, 0]
    for batch in batches:
        if not batch.num_rows:
            continue
        value, file, start, line = (batch.column(c) for c in ("value", "file", "start", "line"))
        if (np.diff(line.to_numpy()) <= 0).any():
            raise ValueError("lines are not in file order")
        odd = pc.count_substring(value, '"').to_numpy().astype(np.int64) % 2
        blank = pc.equal(pc.ascii_rtrim(value, characters="\r"), "").to_numpy(zero_copy_only=False)
        moved = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1]))
        bounds = [0, *(np.flatnonzero(moved.to_numpy(zero_copy_only=False)) + 1), len(odd)]
        opened, counts = np.empty(len(odd), np.int64), np.empty((2, len(odd)), np.int64)
        for low, high in zip(bounds, bounds[1:]):
            split = (file[low].as_py(), start[low].as_py())
            if split != last:
                last, odds, begun = split, 0, [0, 0]
            sums = odds + np.cumsum(odd[low:high])
            opened[low:high] = (sums - odd[low:high]) % 2
            odds = int(sums[-1])
            for i in (0, 1):
                counts[i, low:high] = begun[i] + np.cumsum((opened[low:high] == i) & ~blank[low:high])
                begun[i] = int(counts[i, high - 1])
        made = [pa.array(x, kind) for x, kind in zip((odd, blank, opened, *counts), MARKS.values())]
        yield pa.RecordBatch.from_arrays([*([value] if values else []), file, start, line, *made],
                                         [*(["value"] if values else []), "file", "start", "line", *MARKS])


def _lines(spark: SparkSession, path: str, values: bool, only: DataFrame | None = None) -> DataFrame:
    """Physical lines with what is known within their split: whether a quote is open before the line, and how many records
    begin up to it, if none is open where the split begins (0) or if one is (1). A task reads a split's lines in turn, so
    they are counted as they are read and not shuffled. Without `values` the texts stay behind; `only` names splits."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"))
    if only is not None:
        lines = lines.join(F.broadcast(only), ["file", "start"], "left_semi").select(lines.columns)
    return lines.mapInArrow(partial(_marked, values=values), ("value string, " if values else "") + MARKED)


def _splits(spark: SparkSession, path: str) -> DataFrame:
    """One row per split: whether it begins inside a cell (`inside`), whether a cell of several lines touches it (`broken`),
    how many records begin before it in its file (`before`), and how many rows are in earlier files."""
    splits = cut(_lines(spark, path, values=False).groupBy("file", "start").agg(
        F.sum("odd").alias("odd"), F.max("n0").alias("n0"), F.max("n1").alias("n1")))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    splits = splits.withColumn("n", F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")))
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    files = splits.groupBy("file").agg(F.greatest(F.sum("n") - 1, F.lit(0)).alias("rows"))
    # One row per file and split.
    in_turn = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("rows").over(in_turn), F.lit(0)).alias("files_before"))
    broken = ((F.col("inside") == 1) | (F.col("odd") > 0)).alias("broken")
    return splits.join(files, "file").select("file", "start", "inside", broken, "before", "files_before")


def _placed(lines: DataFrame, places: DataFrame) -> DataFrame:
    """Lines with their record's number and whether a quote is open before them, without headers and blank lines between records."""
    # One row per split: sent to the tasks, so that the lines are not shuffled.
    placed = lines.join(F.broadcast(places), ["file", "start"]).select(
        "start", "line", "value", "odd", "files_before", ((F.col("open") + F.col("inside")) % 2).alias("open"), "blank",
        (F.col("before") + F.when(F.col("inside") == 0, F.col("n0")).otherwise(F.col("n1")) - 1).alias("at"))
    # Record 0 of a file is its header; blank lines between records are none.
    return placed.where("at > 0 AND NOT (blank AND open = 0)").withColumn("number", F.col("files_before") + F.col("at") - 1)


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """(record, number): the records of CSV files without their headers, numbered in file order, read by many tasks a file.

    A split cannot know whether it begins inside a cell. So each counts its quotes and its records under both assumptions;
    a scan over one row per split, which are written, says which one holds. A record that is one line needs no more than
    that; only the lines of longer ones, which may lie in two splits, are read once more and meet in a shuffle. Quotes
    occur in quoted cells only, doubled, as CSV writers have it.
    """
    places = _splits(spark, path)
    whole = _placed(_lines(spark, path, values=True), places).where("open = 0 AND odd = 0").select(
        F.col("value").alias("record"), "number")
    broken = places.where("broken").select("file", "start")
    longer = _placed(_lines(spark, path, values=True, only=broken), places).where("open = 1 OR odd = 1").groupBy("number").agg(
        F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("lines"))
    longer = longer.select(F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("record"), "number")
    return whole.unionByName(longer).withColumn("record", F.regexp_replace("record", "\r$", ""))


def _text_columns(spark: SparkSession, path: str, names: Sequence[str], multi_line: bool, order: str | None,
                  nulls: Mapping[str, str] | None = None) -> DataFrame:
    """All cells as text under the given names, behind the row number if one is asked for."""
    if not multi_line:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = spark.read.options(**CSV_OPTIONS, **(nulls or {}), multiLine="false").schema(schema).csv(path)
        return raw if order is None else with_file_order(raw, order)
    cells = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(names))),
                       {k: v for k, v in CSV_OPTIONS.items() if k in ("quote", "escape")} | dict(nulls or {}))
    records = split_records(spark, path).select(F.col("number").cast("long"), cells.alias("cells"))
    numbered = [] if order is None else [F.col("number").alias(order)]
    return records.select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)], *numbered)


def read_tab(spark: SparkSession, path: str, columns: Sequence[str] | None = None, multi_line: bool = True,
             order: str | None = ORDER) -> DataFrame:
    """A tab export: every cell a text, blank and `nan` cells null, rows numbered in file order.

    Cells may hold line breaks; a file is split over tasks all the same. With `multi_line` off no cell may.
    """
    path = current_path(spark, path)
    names = columns
    if names is None:
        names = spark.read.options(**CSV_OPTIONS, multiLine="true", inferSchema="false").csv(path).columns
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    return _text_columns(spark, path, names, multi_line, order, TAB_NULLS)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True,
             order: str | None = None) -> DataFrame:
    """A CSV file of declared types; the usual missing-value words, and cells of the wrong type, are null."""
    names = [f.name for f in schema.fields]
    raw = _text_columns(spark, current_path(spark, path), names, multi_line, order)
    cleaned = null_tokens(raw, CSV_TOKENS, only=names)
    extra = [] if order is None else [col(order)]
    return cleaned.select(*extra, *[
        col(f.name) if isinstance(f.dataType, T.StringType) else col(f.name).try_cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_optional(spark: SparkSession, path: str, schema: T.StructType, order: str | None = None) -> DataFrame:
    """As `read_csv`; a missing file is an empty table."""
    if path_exists(spark, path):
        return read_csv(spark, path, schema, order=order)
    extra = [] if order is None else [T.StructField(order, T.LongType())]
    return spark.createDataFrame([], T.StructType([*extra, *schema.fields]))
