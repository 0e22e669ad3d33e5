"""The several spellings of a missing value, and how they are filled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmatch.functions.columns import quoted, text_literal

# Cell texts that mean "missing" in a spreadsheet tab, in a concatenation, and in a CSV file.
TAB_TOKENS = ("", "nan")
CONCAT_TOKENS = ("<NA>", "NA")
CSV_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def without_tokens(value: Column, tokens: Sequence[str]) -> Column:
    return F.when(value.isin(*tokens), F.lit(None)).otherwise(value)


def null_tokens(df: DataFrame, tokens: Sequence[str] = TAB_TOKENS, only: Sequence[str] | None = None) -> DataFrame:
    """Turn token texts into null in every string column, or in the named ones."""
    chosen = set(string_columns(df) if only is None else only)
    words = ", ".join(text_literal(t) for t in tokens)
    return df.selectExpr(*[
        f"CASE WHEN {quoted(c)} NOT IN ({words}) THEN {quoted(c)} END AS {quoted(c)}" if c in chosen else quoted(c)
        for c in df.columns
    ])


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def fill_constant(df: DataFrame, value: str | int | float, only: Sequence[str] | None = None) -> DataFrame:
    chosen = set(df.columns if only is None else only)
    filler = text_literal(value) if isinstance(value, str) else str(value)
    kinds = dict(df.dtypes)
    return df.selectExpr(*[
        f"coalesce({quoted(c)}, CAST({filler} AS {kinds[c]})) AS {quoted(c)}" if c in chosen else quoted(c)
        for c in df.columns
    ])


def fill_keyed_rows(df: DataFrame, key: str, word: str = "NA", only: Sequence[str] | None = None) -> DataFrame:
    """Null or blank cells become `word`, but only on rows whose key is present."""
    chosen = set(df.columns if only is None else only)
    cell = "CAST({0} AS STRING)"
    filled = f"CASE WHEN {quoted(key)} IS NOT NULL THEN coalesce(nullif({cell}, ''), {text_literal(word)}) ELSE {cell} END AS {{0}}"
    return df.selectExpr(*[filled.format(quoted(c)) if c in chosen else quoted(c) for c in df.columns])


def is_valid_label(value: Column) -> Column:
    """Neither null, nor blank, nor the literal NA."""
    return value.isNotNull() & ~value.isin("NA", "")


def number_or_zero(value: Column) -> Column:
    return F.coalesce(value.try_cast("double"), F.lit(0.0))
