"""Union, keep-last merge, upsert with orphans, three-way combine, append-only sync."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols, join_null_safe
from rollmatch.operators.dedupe import keep_last
from rollmatch.operators.order import ORDER
from rollmatch.operators.schema import align_schema, common_columns, key_text, tag_column

SOURCE = "_src"


def stack_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name, absent columns null; `_src` numbers the inputs so that (`_src`, order) is the row order."""
    tagged = [t.withColumn(SOURCE, F.lit(i)) for i, t in enumerate(tables)]
    union = tagged[0]
    for nxt in tagged[1:]:
        union = union.unionByName(nxt, allowMissingColumns=True)
    return union


def drop_empty(tables: Sequence[DataFrame]) -> list[DataFrame]:
    """The inputs that hold rows; all of them empty is an error."""
    kept = [t for t in tables if not t.isEmpty()]
    if not kept:
        raise ValueError("all inputs are empty")
    return kept


def _stacked_order(order: str) -> Column:
    return F.struct(F.col(SOURCE), col(order))


def _last_of_stack(union: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    marked = union.withColumn("__at", _stacked_order(order))
    return keep_last(marked, keys, "__at").drop("__at")


def drop_blank_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key is more than blanks; a null key stays."""
    return df.where(F.coalesce(key_text(col(key)), F.lit("<NA>")) != "")


def merge_old_new(old: DataFrame, new: DataFrame, status: str, old_label: str, new_label: str,
                  order: str = ORDER) -> DataFrame:
    """Tag both sides, stack them, keep the last row per first column, drop blank ids (a null id stays)."""
    key = next(c for c in old.columns if c != order)
    union = stack_tables([tag_column(old, status, old_label), tag_column(new, status, new_label)])
    merged = _last_of_stack(union, [key], order)
    return drop_blank_keys(merged, key).drop(SOURCE)


def upsert_with_orphans(merged: DataFrame, main: DataFrame, key: str) -> DataFrame:
    """The merged rows, then the main rows whose trimmed key is not among them."""
    left = merged.withColumn(key, key_text(col(key)))
    keep = main.withColumn(key, key_text(col(key)) if key in main.columns else F.lit(""))
    orphans = join_null_safe(keep, left.select(col(key)).distinct(), [key], "left_anti")
    return left.unionByName(orphans, allowMissingColumns=True)


def combine_keep_last(tables: Sequence[DataFrame], keys: Sequence[str], order: str = ORDER) -> DataFrame:
    """Stack the inputs and keep the last row per composite key (those key columns that exist)."""
    return _last_of_stack(stack_tables(tables), keys, order).drop(SOURCE)


def new_key_rows(source: DataFrame, target: DataFrame, source_key: str, target_key: str | None = None) -> DataFrame:
    """Source rows whose trimmed text key the target lacks; every such row is kept, duplicates too.

    Missing keys compare as equal. Target keys are made distinct before the shuffle.
    """
    known = target.select(key_text(col(target_key or source_key)).alias("__known")).distinct()
    return source.join(known, key_text(col(source_key)).eqNullSafe(F.col("__known")), "left_anti")


def new_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows that no target row equals on all common columns, null equal to null, compared as text."""
    shared = common_columns(source, target)
    known = target.select(*[col(c).cast("string").alias(f"__k{i}") for i, c in enumerate(shared)]).distinct()
    same = F.lit(True)
    for i, c in enumerate(shared):
        same = same & col(c).cast("string").eqNullSafe(F.col(f"__k{i}"))
    return source.join(known, same, "left_anti")


def sync_aligned(source: DataFrame, target: DataFrame, key: str, target_is_empty: bool | None = None) -> DataFrame:
    """Rows to append to the target, in its layout. An empty target takes the source as it is."""
    if target.isEmpty() if target_is_empty is None else target_is_empty:
        return source
    return align_schema(new_key_rows(source, target, key), target.columns)


def strict_append_rows(source: DataFrame, target: DataFrame | None, columns: Sequence[str]) -> DataFrame:
    """Exactly the given columns as text, missing ones and nulls empty, only keys (first column) the target lacks."""
    laid_out = align_schema(source, columns).select(*[
        F.coalesce(col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    if target is None or columns[0] not in [c.strip() for c in target.columns]:
        return laid_out
    held = next(c for c in target.columns if c.strip() == columns[0])
    return new_key_rows(laid_out, target, columns[0], held).select(*cols(columns))
