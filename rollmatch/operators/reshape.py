"""Explode, long to wide, wide to long, and the structured/list split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmatch.functions.columns import col, cols
from rollmatch.functions.nulls import blank_to_null, is_valid_label
from rollmatch.functions.text import department_label
from rollmatch.session import cut


def explode_paired(df: DataFrame, paired: Sequence[str]) -> DataFrame:
    """Explode several list columns together; unequal lengths in a row fail the job.

    A null or empty list counts as one null item.
    """
    def items(name: str) -> Column:
        kind = df.schema[name].dataType.elementType
        return F.when(F.size(col(name)) > 0, col(name)).otherwise(F.array(F.lit(None).cast(kind)))

    sizes = [F.size(items(c)) for c in paired]
    same = F.lit(True)
    for s in sizes[1:]:
        same = same & (s == sizes[0])
    zipped = F.arrays_zip(*[items(c).alias(f"p{i}") for i, c in enumerate(paired)])
    checked = F.when(same, zipped).otherwise(F.raise_error(F.lit("paired lists differ in length")))
    rows = df.withColumn("__pair", F.explode(checked))
    place = {c: f"p{i}" for i, c in enumerate(paired)}
    return rows.select(*[
        F.col("__pair").getField(place[c]).alias(c) if c in place else col(c) for c in df.columns])


def explode_column(df: DataFrame, key: str, name: str) -> DataFrame:
    """A list column as its own long table of (key, item)."""
    return df.select(col(key), F.explode_outer(col(name)).alias(name))


def ranked_to_wide(long: DataFrame, key: str, rank: str, values: Mapping[str, str], k: int,
                   pad: Mapping[str, object]) -> DataFrame:
    """One row per key with `heading: 1..k` for each value column; a missing rank shows the value's pad.

    `values` maps a value column to its heading, `pad` a value column to the filler.
    """
    aggregates, shown = [], []
    for value, heading in values.items():
        kind = long.schema[value].dataType
        for i in range(1, k + 1):
            name = f"{heading}: {i}"
            cell = F.struct(col(value).alias("v"))
            aggregates.append(F.max(F.when(col(rank) == i, cell)).alias(name))
            filler = pad.get(value)
            # A real null stays null; only an absent rank is padded.
            shown.append(F.when(col(name).isNull(), F.lit(filler).cast(kind)).otherwise(col(name)["v"]).alias(name))
    wide = long.groupBy(col(key)).agg(*aggregates)
    return wide.select(col(key), *shown)


def wide_to_ranked(df: DataFrame, key: str, triples: Sequence[tuple[str, str, str]],
                   names: Sequence[str] = ("Job Title Prediction", "VRF ID", "Department", "Rank")) -> DataFrame:
    """One row per key and rank from (title, id, department) column triples.

    The department text is cut at the colon. A department column without any value gives way to the id column.
    Rows without a title are dropped; missing texts show as NA.
    """
    title, ident, dept, rank = names
    present = [(n, t) for n, t in enumerate(triples, start=1) if t[0] in df.columns]
    departments = [t[2] for _, t in present if t[2] in df.columns]
    # Whether a whole column is null or blank is observed while the needed columns are written.
    blank: set[str] = set()
    if departments:
        seen = Observation()
        needed = df.select(*cols(dict.fromkeys([key, *[c for _, t in present for c in t if c in df.columns]])))
        df = cut(needed.observe(seen, *[F.count(blank_to_null(col(c))).alias(f"n{i}") for i, c in enumerate(departments)]))
        blank = {c for i, c in enumerate(departments) if not seen.get[f"n{i}"]}
    rows = []
    for n, (job_col, id_col, dept_col) in present:
        id_value = col(id_col) if id_col in df.columns else F.lit("NA")
        raw = col(id_col) if id_col in df.columns else F.lit(None).cast("string")
        if dept_col in departments and dept_col not in blank:
            raw = col(dept_col)
        rows.append(F.struct(
            col(job_col).cast("string").alias(title), id_value.cast("string").alias(ident),
            department_label(raw.cast("string")).alias(dept), F.lit(n).alias(rank)))
    if not rows:
        raise ValueError("no title column to unpivot")
    long = df.select(col(key), F.explode(F.array(*rows)).alias("__r"))
    flat = long.select(col(key), *[F.col("__r").getField(n).alias(n) for n in names])
    return flat.where(is_valid_label(col(title))).select(
        F.coalesce(col(key).cast("string"), F.lit("NA")).alias(key),
        *[F.coalesce(col(n), F.lit("NA")).alias(n) for n in (title, ident, dept)], col(rank))


def join_lists(df: DataFrame, columns: Sequence[str] | None = None, sep: str = ", ") -> DataFrame:
    """List columns of texts as one text each."""
    listed = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    chosen = listed if columns is None else listed & set(columns)
    return df.select(*[F.array_join(col(c), sep).alias(c) if c in chosen else col(c) for c in df.columns])


def select_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """List columns with an empty list where null."""
    return df.select(*[
        F.coalesce(col(c), F.array().cast(df.schema[c].dataType)).alias(c) if c in columns else col(c)
        for c in df.columns])


def sort_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*cols(columns))
