"""Job requests: clean-up, reconciliation with older requests, and the vector table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols
from rollmatch.functions.nulls import fill_constant
from rollmatch.functions.text import generic_job_summary, newline_cells, specific_job_summary
from rollmatch.operators.merge import (
    combine_keep_last, drop_empty, merge_old_new, new_key_rows, stack_tables, upsert_with_orphans,
)
from rollmatch.operators.order import ORDER, number_rows
from rollmatch.operators.rollup import roll_up_lists, roll_up_text
from rollmatch.operators.schema import select_preferred
from rollmatch.operators.vectors import embed_text
from rollmatch.plans import layouts as L
from rollmatch.session import cut
from rollmatch.sources.sinks import read_table, write_vectors


def clean_requests(raw: DataFrame, order: str = ORDER) -> DataFrame:
    """One row per request: key filled down, two columns concatenated, preferred column order."""
    keep = [c for c in L.REQUEST_ORDER if c in raw.columns]
    rolled = roll_up_text(raw, [L.REQUEST_KEY], L.REQUEST_CONCAT, keep, L.REQUEST_KEY, order)
    return select_preferred(rolled, L.REQUEST_ORDER, L.REQUEST_ADDED)


def reconcile_requests(clean: DataFrame, new: DataFrame, old: DataFrame, main: DataFrame,
                       order: str = ORDER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows to append to the new table, merged old and new, main table after the update)."""
    to_append = new_key_rows(clean, new, L.REQUEST_KEY)
    stacked = stack_tables([new, to_append])
    high = new.agg(F.coalesce(F.max(col(order)), F.lit(-1))).scalar()
    current = stacked.withColumn(
        order, F.when(F.col("_src") == 1, high + 1 + col(order)).otherwise(col(order))).drop("_src")
    merged = merge_old_new(old, current, L.STATUS, L.OLD_LABEL, L.NEW_LABEL, order).drop(order)
    return to_append, merged, upsert_with_orphans(merged, main, L.REQUEST_KEY)


def combine_requests(new: DataFrame, old: DataFrame, generic: DataFrame, order: str = ORDER) -> DataFrame:
    """New, old and generic rows in one table, the last row per request and title."""
    return combine_keep_last(drop_empty([new, old, generic]), L.REQUEST_DEDUP, order)


def job_texts(requests: DataFrame, generic: DataFrame, order: str = ORDER, legacy: bool = False) -> DataFrame:
    """Title, request, department and summary text per job; requests in key order of first row, generic jobs after.

    Rows without a request name are generic jobs that came along; `legacy` rolls them into the request above.
    """
    rows = requests if legacy else requests.where(col(L.REQUEST_KEY).isNotNull())
    fill = list(L.REQUEST_REQUIRED)
    placed = roll_up_lists(rows, fill, L.REQUEST_LISTS, L.REQUEST_KEY, order, keep_order=True)
    whole = fill_constant(placed.na.drop(subset=fill), "NA", only=fill)
    texts = {c: newline_cells(col(c)) for c in fill}
    specific = whole.select(
        col(order), *[texts[c].alias(c) for c in L.NODE_METADATA],
        specific_job_summary(texts["Job Title"], texts["Job Description"], col("Skills/Keywords"), col("Skills"),
                             col("Languages")).alias("summary"))
    general = generic.select(
        col(order), col("Job Title"), F.lit("").alias("Request Name"), F.lit("").alias("Department"),
        generic_job_summary(col("Job Title"), col(L.GENERIC_DESCRIPTION)).alias("summary"))
    return stack_tables([specific, general])


def index_nodes(jobs: DataFrame, embed: Callable[[DataFrame, str, str], DataFrame] = embed_text,
                order: str = ORDER) -> DataFrame:
    """Vector table rows: sequential id over all jobs, empty texts left out, metadata and embedding.

    Jobs are numbered in (`_src`, order) order; `embed(docs, key, text)` returns (key, embedding).
    """
    jobs = cut(jobs)
    first, rest = (number_rows(jobs.where(F.col("_src") == side), "id", order) for side in (0, 1))
    before = jobs.agg(F.count(F.when(F.col("_src") == 0, 1))).scalar()
    numbered = first.unionByName(rest.withColumn("id", F.col("id") + before))
    nodes = cut(numbered.where(F.length("summary") > 0).select(
        F.col("id").cast("string").alias("id"), F.col("summary").alias("text"), *cols(L.NODE_METADATA)))
    vectors = embed(nodes, "id", "text")
    return nodes.join(vectors.withColumnRenamed("id", "__id"), F.col("id") == F.col("__id"), "left").drop("__id")


def requests_job(clean: DataFrame, new: DataFrame, old: DataFrame, main: DataFrame, generic: DataFrame, table: str,
                 embed: Callable[[DataFrame, str, str], DataFrame] = embed_text, order: str = ORDER) -> dict[str, DataFrame]:
    """Reconcile, combine, index: the rows to append, the merged rows, the updated main table, and the vector table.

    `clean`, `new`, `old` and `generic` are request rows in one layout with a row order; the vector table at `table` is
    overwritten by the texts of the combined requests and of the generic jobs.
    """
    to_append, merged, updated = reconcile_requests(clean, new, old, main, order)
    combined = combine_requests(new, old, generic, order)
    write_vectors(index_nodes(job_texts(combined, generic, order), embed, order), table)
    return {"to_append": to_append, "merged": merged, "main": updated,
            "nodes": read_table(clean.sparkSession, table)}
