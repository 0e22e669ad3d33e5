"""Scanning a folder of run logs for the first line that reports trouble."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, strip

# Words that mark a failed run, in any case.
TROUBLE = ("error", "exception", "failed", "traceback")


def reports_trouble(line: Column, words: Sequence[str] = TROUBLE) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.lower(line), F.lit(word))
    return found


def first_trouble(lines: DataFrame, file: str, order: str | Column, line: str,
                  words: Sequence[str] = TROUBLE) -> DataFrame:
    """Per file whether a line reports trouble, and the first such line, stripped."""
    at = col(order) if isinstance(order, str) else order
    hit = F.when(reports_trouble(col(line), words), at)
    return lines.groupBy(col(file)).agg(
        F.count(hit).alias("hits"), F.min_by(strip(col(line)), hit).alias("first_line"),
    ).select(col(file), (F.col("hits") > 0).alias("has_error"), "first_line")


def scan_logs(spark: SparkSession, path: str, words: Sequence[str] = TROUBLE) -> DataFrame:
    """`first_trouble` over the text files below a folder; split files keep their line order."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("here"))
    return first_trouble(lines, "file", F.struct("start", "here"), "line", words)
