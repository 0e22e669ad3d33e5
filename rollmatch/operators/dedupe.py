"""Keep-first and keep-last by key, as aggregates that combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols
from rollmatch.operators.order import ORDER


def _keep(df: DataFrame, keys: Sequence[str], order: str, last: bool) -> DataFrame:
    pick = F.max_by if last else F.min_by
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.lit(0).alias("__z"), *cols(rest))
    kept = df.groupBy(*cols(keys)).agg(pick(row, col(order)).alias("__row"))
    return kept.select(*[
        (col(c) if c in keys else F.col("__row").getField(c).alias(c)) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: str = ORDER) -> DataFrame:
    """The first row per key in row order; rows with a null key count as one key."""
    return _keep(df, keys, order, last=False)


def keep_last(df: DataFrame, keys: Sequence[str], order: str = ORDER) -> DataFrame:
    """The last row per key, over those key columns the table has; without any, the table as it is."""
    present = [k for k in keys if k in df.columns]
    return _keep(df, present, order, last=True) if present else df


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df if columns is None else df.select(*cols(columns))).distinct()
