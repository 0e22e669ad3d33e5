"""Participants as SQL tables: a structured one, a list-text one and a language table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.functions.nulls import fill_constant
from rollmatch.functions.text import record_text
from rollmatch.operators.order import BLOCK, ORDER
from rollmatch.operators.reshape import explode_column, explode_paired, join_lists
from rollmatch.operators.rollup import roll_up_items
from rollmatch.operators.schema import select_exact
from rollmatch.plans import layouts as L
from rollmatch.sources.sqltables import publish_view


def structured_table(participants: DataFrame) -> DataFrame:
    """One row per participant and job period."""
    rows = explode_paired(select_exact(participants, L.STRUCTURED), L.STRUCTURED[3:])
    return fill_constant(rows, "NA", only=[c for c in L.STRUCTURED if c != L.KEY])


def language_table(participants: DataFrame) -> DataFrame:
    """One row per participant and language."""
    return fill_constant(explode_column(participants, L.KEY, "Languages"), "NA", only=["Languages"])


def unstructured_table(participants: DataFrame) -> DataFrame:
    return join_lists(select_exact(participants, L.UNSTRUCTURED))


def publish_participants(participants: DataFrame) -> None:
    publish_view(structured_table(participants), L.STRUCTURED_TABLE)
    publish_view(language_table(participants), L.LANGUAGE_TABLE)
    publish_view(unstructured_table(participants), L.UNSTRUCTURED_TABLE)


def structured_rows(records: DataFrame, items: DataFrame) -> DataFrame:
    """`structured_table` from the items of `roll_up_items`: no record's dates are ever in one cell."""
    start, end = L.STRUCTURED[3:]
    dates = items.where(F.col("name").isin(start, end))
    count = lambda name: F.count(F.when(F.col("name") == name, 1))
    whole = dates.groupBy(col(L.KEY)).agg((count(start) != count(end)).alias("uneven"), F.bool_or(F.col("value") == "NA").alias("missing"))
    usable = whole.where(~F.col("uneven") & ~F.col("missing")).select(col(L.KEY).alias("k"))
    sides = [dates.where(F.col("name") == n).select(col(L.KEY), "at", F.col("value").alias(n)) for n in (start, end)]
    pairs = sides[0].join(sides[1], [L.KEY, "at"]).join(usable, col(L.KEY) == F.col("k"), "left_semi")
    # A record whose dates do not pair up, or that has none, has one row.
    joined = records.select(*[col(c) for c in L.STRUCTURED[:3]]).withColumnRenamed(L.KEY, "k").join(
        pairs, F.col("k") == col(L.KEY), "left")
    rows = joined.select(F.col("k").cast("long").alias(L.KEY), *[col(c) for c in L.STRUCTURED[1:]])
    return fill_constant(rows, "NA", only=[c for c in L.STRUCTURED if c != L.KEY])


def language_rows(records: DataFrame, items: DataFrame) -> DataFrame:
    """`language_table` from the items of `roll_up_items`."""
    spoken = items.where(F.col("name") == "Languages").select(col(L.KEY), F.col("value").alias("Languages"))
    nobody = records.where(col(L.KEY).isNull()).select(col(L.KEY), F.lit("NA").alias("Languages"))
    return spoken.unionByName(nobody).select(col(L.KEY).cast("long").alias(L.KEY), "Languages")


def participant_items(raw: DataFrame, order: str = ORDER, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Records and list items of the participants, for exports with records too long for a cell."""
    fill = [c for c in L.ALLOCATION_COLUMNS if c not in L.ALLOCATION_LISTS]
    return roll_up_items(raw, fill, L.ALLOCATION_LISTS, L.KEY, order, block=block)


def search_texts(unstructured: DataFrame) -> DataFrame:
    """(key, text) of each participant for the L2 vector index."""
    names = [c for c in unstructured.columns if c != L.KEY]
    return unstructured.select(col(L.KEY), record_text(names).alias("text"))
