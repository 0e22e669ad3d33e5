"""JSON in and out of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollmatch.functions.columns import cols
from rollmatch.functions.nulls import blank_to_null

# Texts written when a tag is absent or the call behind the reply failed.
NO_INFO = "No info found"
FAILED = "Processing failed"

END_MARK = "end of reply"


def row_json(names: Sequence[str]) -> Column:
    """The record as JSON text, null fields kept."""
    return F.to_json(F.struct(*cols(names)), {"ignoreNullFields": "false"})


def json_object(text: Column) -> Column:
    """Map of the JSON object between the first `{` and the last `}`; empty map when it does not parse."""
    body = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    # The parser stops behind the first value, so the object is read as the first of exactly two items: rubbish
    # or a second object behind it spoils the pair.
    pair = F.from_json(F.concat(F.lit("["), body, F.lit(f',"{END_MARK}"]')), "array<string>")
    whole = (F.size(pair) == 2) & (pair.getItem(1) == END_MARK)
    parsed = F.when(whole, F.from_json(body, "map<string,string>"))
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def tag_value(tags: Column, name: str, reply: Column) -> Column:
    """Value of one tag; a default where it is absent, another where there was no reply."""
    return (
        F.when(reply.isNull(), F.lit(FAILED))
        .when(F.map_contains_key(tags, name), F.coalesce(tags.getItem(name), F.lit("")))
        .otherwise(F.lit(NO_INFO))
    )


def first_filled(first: Column, second: Column) -> Column:
    return F.coalesce(blank_to_null(first), second)
