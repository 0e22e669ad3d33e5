"""Column selection, alignment and casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols, strip


def require(df: DataFrame, needed: Sequence[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def select_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return require(df, columns).select(*cols(columns))


def select_preferred(df: DataFrame, preferred: Sequence[str], added: Sequence[str] = ()) -> DataFrame:
    """The preferred columns the table has, in that order; each of `added` it lacks follows as an empty text."""
    kept = [c for c in preferred if c in df.columns]
    extra = [c for c in added if c not in kept]
    return df.select(*cols(kept), *[
        (col(c) if c in df.columns else F.lit("")).alias(c) for c in extra])


def align_schema(df: DataFrame, target: Sequence[str]) -> DataFrame:
    """Exactly the target's columns in its order: missing ones as an empty text, extra ones dropped."""
    return df.select(*[(col(c) if c in df.columns else F.lit("")).alias(c) for c in target])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have, in the right table's order."""
    return [c for c in right.columns if c in set(left.columns)]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    gone = set(names)
    return df.select(*cols(c for c in df.columns if c not in gone))


def move_column(df: DataFrame, name: str, before: str | None = None, after: str | None = None) -> DataFrame:
    anchor = before if before is not None else after
    require(df, [name, anchor])
    rest = [c for c in df.columns if c != name]
    at = rest.index(anchor) + (0 if before is not None else 1)
    return df.select(*cols([*rest[:at], name, *rest[at:]]))


def tag_column(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def to_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast the named columns the table has to text; null stays null."""
    chosen = set(columns)
    return df.select(*[col(c).cast("string").alias(c) if c in chosen else col(c) for c in df.columns])


def key_text(value: Column) -> Column:
    return strip(value.cast("string"))


def normalise_key(df: DataFrame, key: str) -> DataFrame:
    return df.select(*[key_text(col(c)).alias(c) if c == key else col(c) for c in df.columns])


def key_to_integer(df: DataFrame, key: str) -> DataFrame:
    """Text key to a long; a key that is no integer fails the job."""
    return df.select(*[col(c).cast("long").alias(c) if c == key else col(c) for c in df.columns])
