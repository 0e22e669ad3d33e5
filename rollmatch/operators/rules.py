"""Rule update of first-choice predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.functions.nulls import number_or_zero
from rollmatch.functions.text import is_na_list
from rollmatch.operators.schema import require


@dataclass(frozen=True)
class TitleRule:
    """Titles and years of the rule."""

    old_title: str = "Researcher"
    support_title: str = "Ashram Support"
    fresher_title: str = "Fresher"
    years: tuple[int, ...] = (2023, 2024, 2025)


def adjusted_title(title: Column, work: Column, qualification: Column, specialization: Column, year: Column,
                   rule: TitleRule = TitleRule()) -> Column:
    """New title, decided on the old one: without work, a recent graduate is a fresher, anyone else support."""
    no_work = F.coalesce(is_na_list(work), F.lit(False))
    no_study = F.coalesce(is_na_list(qualification) & is_na_list(specialization), F.lit(False))
    recent = number_or_zero(year).isin(*[float(y) for y in rule.years])
    return (
        F.when((title == rule.old_title) & no_work & no_study, F.lit(rule.support_title))
        .when((title == rule.old_title) & no_work & recent, F.lit(rule.fresher_title))
        .when((title == rule.old_title) & no_work, F.lit(rule.support_title))
        .otherwise(title)
    )


def adjust_titles(df: DataFrame, title: str, work: str, qualification: str, specialization: str, year: str,
                  rule: TitleRule = TitleRule()) -> DataFrame:
    require(df, [title, work, qualification, specialization, year])
    new = adjusted_title(col(title), col(work), col(qualification), col(specialization), col(year), rule)
    return df.withColumn(title, new)
