"""Tags per participant from the replies to their records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, join_null_safe
from rollmatch.functions.jsontext import first_filled, json_object, row_json, tag_value
from rollmatch.functions.nulls import blank_to_null
from rollmatch.plans import layouts as L
from rollmatch.session import cut
from rollmatch.sources.sinks import strict_append


def prompts(candidates: DataFrame, key: str = L.KEY) -> DataFrame:
    """(key, record as JSON): what a tagging service is asked about."""
    return candidates.select(col(key), row_json(candidates.columns).alias("record"))


def tag_records(candidates: DataFrame, replies: DataFrame, tags: Sequence[str], key: str = L.KEY,
                at: str | None = None) -> DataFrame:
    """One row per candidate: four fixed columns, then each tag from the reply (`key`, `reply`).

    A candidate without a reply counts as a failed call.
    """
    answered = join_null_safe(candidates, replies.select(col(key), F.col("reply").alias("__reply")), [key], "left")
    have = set(candidates.columns)
    first = col("First Name") if "First Name" in have else F.lit(None).cast("string")
    name = col("Name") if "Name" in have else F.lit("")
    reply = F.col("__reply")
    shown = F.when(reply.isNull(), F.coalesce(blank_to_null(first), F.lit(""))).otherwise(
        F.coalesce(first_filled(first, name), F.lit("")))
    city = F.coalesce(col("City"), F.lit("")) if "City" in have else F.lit("")
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss") if at is None else F.lit(at)
    parsed = answered.withColumn("__tags", json_object(reply))
    return parsed.select(
        col(key), shown.alias("Name"), city.alias("City"), stamp.alias("Processed Date"),
        *[tag_value(F.col("__tags"), t, reply).alias(t) for t in tags])


def append_tags(candidates: DataFrame, replies: DataFrame, path: str, tags: Sequence[str], key: str = L.KEY,
                at: str | None = None) -> None:
    """Tag the candidates and append those that the tag table lacks, in exactly its columns."""
    made = tag_records(candidates, replies, tags, key, at)
    strict_append(cut(made), path, [key, *L.TAG_FIXED[1:], *tags])
