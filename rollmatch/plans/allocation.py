"""Allocation: retrieval per participant, wide results, departments, enrichment and final formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols
from rollmatch.functions.nulls import fill_constant
from rollmatch.functions.text import list_repr, retrieval_text
from rollmatch.operators.lookup import attach_label, enrich, full_join
from rollmatch.operators.order import ORDER, first_rows, sample_rows
from rollmatch.operators.reshape import ranked_to_wide, wide_to_ranked
from rollmatch.operators.rules import adjust_titles
from rollmatch.operators.schema import drop_columns, move_column, require
from rollmatch.operators.vectors import embed_text, fit_terms, retrieve_jobs
from rollmatch.plans import layouts as L
from rollmatch.plans.requests import index_nodes, job_texts
from rollmatch.session import cut
from rollmatch.sources.sinks import read_snapshot, read_table, write_snapshot, write_vectors


def retrieval_input(participants: DataFrame, rows: int | None = None, random: bool = False, seed: int = 0,
                    legacy_duplicate: bool = True) -> DataFrame:
    """Participants with their search text; all of them, the first `rows`, or a random draw.

    The first rows are those in row order where the participants carry one (ORDER), else by key.
    """
    lists = [c for c in L.INPUT_COLUMNS if c != L.KEY]
    placed = [ORDER] if ORDER in participants.columns else []
    texts = participants.select(*cols([*placed, *L.INPUT_COLUMNS])).where(col(L.KEY).isNotNull())
    if rows is not None:
        by = placed[0] if placed else L.KEY
        texts = sample_rows(texts, rows, L.KEY, seed) if random else first_rows(texts, rows, by)
    known = texts.select(col(L.KEY), *[F.coalesce(col(c), F.array(F.lit("NA"))).alias(c) for c in lists])
    # A list value keeps its line breaks; only cells that are plain texts lose theirs.
    return known.withColumn("input", retrieval_text(
        col(L.KEY), *[col(c) for c in lists], legacy_duplicate=legacy_duplicate))


def allocation_job(participants: DataFrame, jobs: DataFrame, generic: DataFrame, table: str, results: str, k: int = 3,
                   width: int = 256, order: str = ORDER) -> DataFrame:
    """From job requests and participants to allocations.

    Job texts are indexed into the vector table at `table`; each participant's search text is embedded with the weights
    of the job texts and meets the indexed jobs; the outcome is a new snapshot below `results`, which is read back.
    """
    texts = cut(job_texts(jobs, generic, order))
    fitted = cut(fit_terms(texts.where(F.length("summary") > 0).select(F.monotonically_increasing_id().alias("id"), "summary"),
                           "id", "summary"))
    write_vectors(index_nodes(texts, lambda d, key, text: embed_text(d, key, text, width, fitted), order), table)
    nodes = read_table(participants.sparkSession, table)
    inputs = cut(retrieval_input(participants))
    vectors = embed_text(inputs, L.KEY, "input", width, fitted).withColumnRenamed(L.KEY, "__key")
    asked = inputs.join(vectors, col(L.KEY) == F.col("__key"), "left").drop("__key")
    write_snapshot(allocate(asked, nodes, jobs, "embedding", k, order), results)
    return read_snapshot(participants.sparkSession, results)


def allocate(inputs: DataFrame, nodes: DataFrame, jobs: DataFrame, vector: str, k: int = 3,
             job_order: str = "_ord", **options) -> DataFrame:
    """Wide predictions of the k nearest jobs per participant, with input columns and departments.

    `inputs` carries the search vector in column `vector`. A participant whose input lists are all `NA`, or for whom
    nothing is found, gets the default job.
    """
    inputs = cut(inputs)
    lists = [c for c in L.INPUT_COLUMNS if c != L.KEY]
    nothing = F.lit(True)
    for c in lists:
        nothing = nothing & F.forall(col(c), lambda x: x == "NA")
    ranked = retrieve_jobs(
        inputs, nodes, k, L.KEY, vector, "id", {"title": "Job Title", "request": "Request Name"},
        searchable=~nothing, default=L.DEFAULT_RESULT, **options)
    # Departments are attached to the ranked rows, by one join however many ranks there are.
    labelled = attach_label(ranked, jobs, "Job Title", "Department", "title", "department", job_order)
    wide = ranked_to_wide(labelled, L.KEY, "rank", {**dict(L.RANKED), "department": "Department"}, k,
                          {"title": "NA", "request": "NA", "score": None, "department": L.NO_DEPARTMENT})
    results = full_join(wide, inputs.select(*cols(L.INPUT_COLUMNS)), L.KEY)
    departments = {f"Department: {i}": f"Department {i}" for i in range(1, k + 1)}
    return results.select(*cols(c for c in results.columns if c not in departments), *[
        F.coalesce(col(made), F.lit("NA")).alias(shown) for made, shown in departments.items()])


def enrich_results(results: DataFrame, participants: DataFrame, k: int = 3) -> DataFrame:
    """Drop scores, attach languages and graduation year, and put them next to the departments."""
    added = ["Languages", L.GRADUATION]
    require(participants, [L.KEY, *added])
    bare = drop_columns(results, [f"{L.SCORE_HEADING}: {i}" for i in range(1, k + 1)])
    joined = enrich(bare, participants, L.KEY, added)
    moved = move_column(joined, "Languages", before="Department 1")
    return move_column(moved, L.GRADUATION, after=f"Department {k}")


def to_predictions(results: DataFrame, lists: Sequence[str] = L.INPUT_COLUMNS[1:], k: int = 3) -> DataFrame:
    """Results under the headings of the predictions table, list columns shown as list text."""
    names = {f"{L.TITLE_HEADING}: {i}": f"Pred Job Title: {i}" for i in range(1, k + 1)}
    names |= {f"{L.REQUEST_HEADING}: {i}": f"Pred VRF ID: {i}" for i in range(1, k + 1)}
    return results.select(*[
        (list_repr(col(c)) if c in lists else col(c)).alias(names.get(c, c)) for c in results.columns])


def tweak_predictions(predictions: DataFrame) -> DataFrame:
    return adjust_titles(
        predictions, "Pred Job Title: 1", "Work Experience/Designation", "Education/Qualifications",
        "Education/Specialization", L.GRADUATION)


def format_predictions(predictions: DataFrame, k: int = 3) -> DataFrame:
    """Ranked rows of all k ranks, sorted by key and rank."""
    return fill_constant(wide_to_ranked(predictions, L.KEY, L.prediction_triples(k)), "NA", only=[L.KEY]).orderBy(
        col(L.KEY), "Rank")
