"""Enrichment joins.

No side is forced into a broadcast: Spark broadcasts a side whose measured size is below its own threshold, and
splits hot keys of a sort-merge join at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols
from rollmatch.functions.nulls import fill_constant
from rollmatch.operators.order import ORDER


def enrich(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], fill: str | None = None) -> DataFrame:
    """Left join on the key as text; a key the right side holds twice doubles the row, and null meets null."""
    looked_up = right.select(col(key).cast("string").alias("__key"), *cols(columns))
    typed = left.withColumn(key, col(key).cast("string"))
    joined = typed.join(looked_up, col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return joined if fill is None else fill_constant(joined, fill, only=columns)


def map_values(df: DataFrame, key: str, lookup: DataFrame, value: str, out: str) -> DataFrame:
    """Look a value up in a table of unique keys; no match gives null."""
    right = lookup.select(col(key).alias("__key"), col(value).alias(out))
    return df.join(right, col(key) == F.col("__key"), "left").drop("__key")


def full_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join with one key column."""
    other = right.withColumnRenamed(key, "__key")
    joined = left.join(other, col(key).eqNullSafe(F.col("__key")), "full")
    return joined.select(
        F.coalesce(col(key), F.col("__key")).alias(key),
        *cols(c for c in left.columns if c != key), *cols(c for c in right.columns if c != key))


def label_lists(jobs: DataFrame, title: str, label: str, order: str = ORDER) -> DataFrame:
    """Per title, its distinct labels in the order they first appear, joined by a comma."""
    firsts = jobs.where(col(label).isNotNull()).groupBy(col(title), col(label)).agg(F.min(col(order)).alias("__at"))
    listed = F.sort_array(F.collect_list(F.struct("__at", col(label).alias("l"))))
    return firsts.groupBy(col(title).alias("__title")).agg(
        F.array_join(F.transform(listed, lambda x: x["l"]), ", ").alias("__labels"))


def label_text(title: Column, labels: Column) -> Column:
    return F.when(title.isNull(), F.lit("NA")).otherwise(
        F.concat(title, F.lit(": "), F.coalesce(labels, F.lit("")), F.lit(" ")))


def attach_label(ranked: DataFrame, jobs: DataFrame, title: str, label: str, predicted: str, out: str,
                 order: str = ORDER) -> DataFrame:
    """The text `title: label, label ` for a title per row: one join, also where a record has many predictions."""
    lists = label_lists(jobs, title, label, order)
    joined = ranked.join(lists, col(predicted) == F.col("__title"), "left")
    return joined.withColumn(out, label_text(col(predicted), F.col("__labels"))).drop("__title", "__labels")


def attach_labels(results: DataFrame, jobs: DataFrame, title: str, label: str, predicted: Sequence[str],
                  out: Sequence[str], order: str = ORDER) -> DataFrame:
    """For each predicted title column, the text `title: label, label `; NA for a missing title."""
    lists = label_lists(jobs, title, label, order)
    joined = results
    for i, (have, want) in enumerate(zip(predicted, out)):
        side = lists.select(F.col("__title").alias(f"__t{i}"), F.col("__labels").alias(f"__l{i}"))
        joined = joined.join(side, col(have) == F.col(f"__t{i}"), "left")
        joined = joined.withColumn(want, label_text(col(have), F.col(f"__l{i}"))).drop(f"__t{i}", f"__l{i}")
    return joined
