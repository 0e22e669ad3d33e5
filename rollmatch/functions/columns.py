"""Column references by exact name and a null-safe equi-join.

Spreadsheet headings hold dots, slashes and spaces, so a heading is always quoted before it is used.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(names: Iterable[str]) -> list[str]:
    return [quoted(n) for n in names]


def listed(names: Iterable[str]) -> str:
    return ", ".join(cols(names))


def text_literal(value: str) -> str:
    """SQL string literal. Wide tables are expressed in SQL text: one call per column instead of many."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Characters stripped from both ends of a key or label.
WHITESPACE = " \t\n\r\f\v"


def strip(value: Column) -> Column:
    return F.trim(value, F.lit(WHITESPACE))


def block_of(order: str, size: int) -> str:
    """SQL for the block of `size` consecutive values an integer belongs to.

    The division is exact (a double quotient would lose digits above 2^53), and never null, so that a join on the
    block adds no null filter that would keep two uses of one shuffle from being the same.
    """
    return f"coalesce(CAST({quoted(order)} AS BIGINT) div {size}, 0)"


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null equals null; the result keeps the left key columns only."""
    renamed = right.select(
        *[col(k).alias(f"__r{i}") for i, k in enumerate(keys)],
        *cols(c for c in right.columns if c not in keys),
    )
    condition = F.lit(True)
    for i, key in enumerate(keys):
        condition = condition & col(key).eqNullSafe(F.col(f"__r{i}"))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"__r{i}" for i in range(len(keys))])
