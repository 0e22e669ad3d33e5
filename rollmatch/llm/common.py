"""Helpers that several training-data operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollmatch.functions.columns import quoted

# A word is a run of characters other than these (blank, and tab to carriage return).
SPACE = r"[ \t-\r]+"
ROW = "__row"


def nested(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole input row under one name, so that no column of the caller's can clash with a working column."""
    return docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(ROW),
                       *[value.alias(name) for name, value in columns.items()])


def unnested(df: DataFrame, *more: str) -> DataFrame:
    """The caller's columns again; a result column replaces a column of the same name."""
    own = [c for c in df.schema[ROW].dataType.fieldNames() if c not in more]
    return df.select(*[F.col(f"{ROW}.{quoted(c)}") for c in own], *more)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    """Number of words, without building them: blanks are counted, and only a text with blanks in a row is tidied first."""
    plain = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\f\r":
        plain = F.replace(plain, F.lit(space), F.lit(" "))
    plain = F.trim(plain)

    def blanks(value: Column) -> Column:
        return F.octet_length(value) - F.octet_length(F.replace(value, F.lit(" "), F.lit("")))

    return (F.when(plain == "", F.lit(0)).when(F.contains(plain, F.lit("  ")), blanks(F.regexp_replace(plain, " +", " ")) + 1)
            .otherwise(blanks(plain) + 1).cast("long"))


def all_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def with_fields(df: DataFrame, names: Sequence[str], more: str) -> StructType:
    """A schema of the named columns of a table and further ones; StructType keeps names that a DDL text would break on."""
    return StructType([df.schema[n] for n in names] + StructType.fromDDL(more).fields)


def unit_interval(value: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes to numbers strictly between 0 and 1."""
    return ((value >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
