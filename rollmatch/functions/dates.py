"""Dates written as text, durations, and lists of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date text and the length of a year in days.
DAY_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}$"
DAY_FORMAT = "yyyy-M-d"
YEAR_DAYS = 365.0


def parse_day(text: Column) -> Column:
    """Date from year-month-day text (unpadded parts allowed); anything else is null."""
    return F.try_to_date(F.when(text.rlike(DAY_TEXT), text), DAY_FORMAT)


def month_difference(start: Column, end: Column) -> Column:
    """Calendar months from start to end; the day of the month does not count."""
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def _unusable(starts: Column, ends: Column, word: str) -> Column:
    return (
        (F.size(starts) != F.size(ends))
        | F.array_contains(starts, word)
        | F.array_contains(ends, word)
    )


def repair_date_lists(starts: Column, ends: Column, word: str = "NA") -> tuple[Column, Column]:
    """Both lists become `[word]` when their sizes differ or either holds `word`."""
    broken = _unusable(starts, ends, word)
    single = F.array(F.lit(word))
    return F.when(broken, single).otherwise(starts), F.when(broken, single).otherwise(ends)


def years_between_lists(starts: Column, ends: Column, word: str = "NA") -> Column:
    """Years per (start, end) pair, null where a date is unusable; null list if the lists do not pair up."""
    years = F.zip_with(
        starts, ends,
        lambda s, e: F.round(F.date_diff(parse_day(e), parse_day(s)) / F.lit(YEAR_DAYS), 2),
    )
    return F.when(~_unusable(starts, ends, word) & (F.size(starts) > 0), years)
