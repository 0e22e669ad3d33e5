"""Whole jobs from tab to tab: each stage reads what is published, and publishes what it makes.

Every function below publishes one step of a job to the folders named in its sheets and returns their paths; the two jobs
at the end string them together as restartable stages.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.functions.text import list_repr
from rollmatch.operators.merge import merge_old_new, new_key_rows, upsert_with_orphans
from rollmatch.operators.order import ORDER
from rollmatch.plans import layouts as L
from rollmatch.plans.allocation import (
    allocation_job, enrich_results, format_predictions, to_predictions, tweak_predictions,
)
from rollmatch.plans.participants import map_ids, participant_frame, roll_up_participants
from rollmatch.plans.requests import clean_requests, combine_requests, index_nodes, job_texts
from rollmatch.plans.stages import Stages
from rollmatch.plans.sync import append_filled, append_participants, append_predictions
from rollmatch.session import cut
from rollmatch.sources.appendlog import AppendLog
from rollmatch.sources.sinks import read_snapshot, snapshot_path, write_csv, write_tab, write_vectors
from rollmatch.sources.tabs import read_tab


@dataclass(frozen=True)
class ParticipantSheets:
    """Folders of the participants' job. Tabs are replaced, backend tables grow."""

    export: str             # tab: several rows per participant
    mapping: str            # tab: key, person id, name
    requests: str           # tab: cleaned job requests
    generic: str            # tab: generic jobs
    rolled: str             # tab: one row per participant
    filled: str             # tab: filled-down rows
    final: str              # tab: rolled rows with person id and name
    vectors: str            # vector table
    results: str            # snapshots of allocations
    allocation: str         # tab: enriched allocations
    backend_filled: str     # grows
    backend_participants: str
    backend_predictions: str
    predictions: str        # tab: all predictions after the rules
    formatted: str          # tab: one row per rank
    final_csv: tuple[str, ...] = ()
    allocation_csv: tuple[str, ...] = ()


@dataclass(frozen=True)
class RequestSheets:
    """Folders of the job requests' job."""

    requests: str           # tab: several rows per request
    generic: str            # tab: generic jobs
    old: str                # tab: older requests
    clean: str              # tab: one row per request
    new: str                # grows: requests as they were first seen
    merged: str             # tab: old and new
    main: str               # tab: the main table, replaced by what is read from it
    vectors: str            # vector table
    clean_csv: tuple[str, ...] = ()


def _written(table: DataFrame, tab: str, csv: Sequence[str] = ()) -> dict[str, str]:
    """The same rows as a tab and as CSV copies, computed once."""
    rows = cut(table) if csv else table
    made = {"tab": write_tab(rows, tab)}
    if csv:
        made |= {f"csv{i}": path for i, path in enumerate(write_csv(rows, csv))}
    return made


def publish_rolled(spark: SparkSession, at: ParticipantSheets, center: str, answers: Sequence[str] = ()) -> dict[str, str]:
    """Roll the export up: one row per participant, and the filled-down copy."""
    rolled, filled = roll_up_participants(cut(read_tab(spark, at.export)), center, answers)
    return {"rolled": write_tab(rolled, at.rolled), "filled": write_tab(filled, at.filled)}


def publish_final(spark: SparkSession, at: ParticipantSheets) -> dict[str, str]:
    """Attach person id and name; the tab and its CSV copies."""
    final = map_ids(read_tab(spark, at.rolled, order=None), read_tab(spark, at.mapping, order=None))
    return _written(final, at.final, at.final_csv)


def publish_results(spark: SparkSession, at: ParticipantSheets, k: int = 3, width: int = 256) -> dict[str, str]:
    """Index the job texts, allocate every participant: a new snapshot."""
    people = participant_frame(cut(read_tab(spark, at.final)), keep_order=True)
    allocation_job(people, read_tab(spark, at.requests), read_tab(spark, at.generic), at.vectors, at.results, k, width)
    return {"results": snapshot_path(spark, at.results)}


def publish_allocation(spark: SparkSession, at: ParticipantSheets, k: int = 3) -> dict[str, str]:
    """The latest results with languages and graduation year, lists as list text."""
    enriched = enrich_results(read_snapshot(spark, at.results), read_tab(spark, at.final, order=None), k)
    lists = L.INPUT_COLUMNS[1:]
    shown = enriched.select(*[list_repr(col(c)).alias(c) if c in lists else col(c) for c in enriched.columns])
    return _written(shown, at.allocation, at.allocation_csv)


def _counted(report: DataFrame) -> dict[str, str]:
    return {name: str(value) for name, value in report.first().asDict().items()}


def sync_backend_filled(spark: SparkSession, at: ParticipantSheets, batch: str | None = None) -> dict[str, str]:
    return _counted(append_filled(read_tab(spark, at.filled, order=None), at.backend_filled, batch))


def sync_backend_participants(spark: SparkSession, at: ParticipantSheets, batch: str | None = None) -> dict[str, str]:
    return _counted(append_participants(read_tab(spark, at.final, order=None), at.backend_participants, batch))


def sync_backend_predictions(spark: SparkSession, at: ParticipantSheets, batch: str | None = None, k: int = 3) -> dict[str, str]:
    """Append by position; the first batch gives the table its headings."""
    rows = to_predictions(read_tab(spark, at.allocation, order=None), lists=(), k=k)
    return _counted(append_predictions(rows, at.backend_predictions, batch))


def publish_formatted(spark: SparkSession, at: ParticipantSheets, k: int = 3) -> dict[str, str]:
    """Apply the rules to all predictions, and lay them out as one row per rank, sorted by key and rank."""
    tweaked = cut(tweak_predictions(AppendLog(spark, at.backend_predictions).read()))
    ranked = format_predictions(tweaked, k)
    return {"predictions": write_tab(tweaked, at.predictions), "formatted": write_tab(ranked, at.formatted)}


def participants_job(spark: SparkSession, at: ParticipantSheets, manifest: str, run: str, center: str,
                     answers: Sequence[str] = (), k: int = 3, width: int = 256) -> Stages:
    """From the participants' export to ranked predictions. Started again under the same run, it goes on where it stopped."""
    stages = Stages(spark, manifest, run)
    stages.do("rolled", lambda: publish_rolled(spark, at, center, answers))
    stages.do("final", lambda: publish_final(spark, at))
    stages.do("results", lambda: publish_results(spark, at, k, width))
    stages.do("allocation", lambda: publish_allocation(spark, at, k))
    stages.do("sync-filled", lambda: sync_backend_filled(spark, at, stages.batch("filled")))
    stages.do("sync-participants", lambda: sync_backend_participants(spark, at, stages.batch("participants")))
    stages.do("sync-predictions", lambda: sync_backend_predictions(spark, at, stages.batch("predictions"), k))
    stages.do("formatted", lambda: publish_formatted(spark, at, k))
    return stages


def publish_clean(spark: SparkSession, at: RequestSheets) -> dict[str, str]:
    """One row per request; the tab and its CSV copies."""
    return _written(clean_requests(cut(read_tab(spark, at.requests))), at.clean, at.clean_csv)


def sync_new_requests(spark: SparkSession, at: RequestSheets, batch: str | None = None) -> dict[str, str]:
    """Append the requests whose key the growing table lacks, by position, numbered on from its last row."""
    clean = read_tab(spark, at.clean)

    def unseen(table: DataFrame | None) -> DataFrame:
        if table is None:
            return clean
        last = table.agg(F.max(col(ORDER))).first()[0]
        rows = new_key_rows(clean, table, L.REQUEST_KEY).withColumn(ORDER, col(ORDER) + F.lit(last + 1))
        names = [c for c in rows.columns if c != ORDER]
        targets = [c for c in table.columns if c != ORDER]
        return rows.select(*[col(ORDER) if t == ORDER else col(dict(zip(targets, names))[t]).alias(t) for t in table.columns])

    log = AppendLog(spark, at.new)
    entry = log.append(unseen, batch)
    return {"rows_added": str(log.read([entry]).count())}


def publish_merged(spark: SparkSession, at: RequestSheets) -> dict[str, str]:
    """Old and new requests, the last row per key, tagged by where it comes from."""
    new = AppendLog(spark, at.new).read()
    merged = merge_old_new(read_tab(spark, at.old), new, L.STATUS, L.OLD_LABEL, L.NEW_LABEL)
    return {"merged": write_tab(merged.drop(ORDER), at.merged)}


def publish_main(spark: SparkSession, at: RequestSheets) -> dict[str, str]:
    """Replace the main table by the merged rows and those of its own rows that are not among them."""
    merged, main = (read_tab(spark, path, order=None) for path in (at.merged, at.main))
    return {"main": write_tab(upsert_with_orphans(merged, main, L.REQUEST_KEY), at.main)}


def publish_vectors(spark: SparkSession, at: RequestSheets, **options) -> dict[str, str]:
    """Index the texts of all requests, newest first seen, and of the generic jobs."""
    generic = read_tab(spark, at.generic)
    # One row order through all three: new requests, older ones, generic jobs.
    in_turn = [t.withColumn(ORDER, col(ORDER) + F.lit(i << 40)) for i, t in enumerate(
        (read_tab(spark, at.clean), read_tab(spark, at.old), generic))]
    combined = combine_requests(*in_turn)
    return {"vectors": write_vectors(index_nodes(job_texts(combined, generic), **options), at.vectors)}


def requests_job(spark: SparkSession, at: RequestSheets, manifest: str, run: str) -> Stages:
    """From job requests to the main table and the vector table, restartable as the participants' job."""
    stages = Stages(spark, manifest, run)
    stages.do("clean", lambda: publish_clean(spark, at))
    stages.do("sync-new", lambda: sync_new_requests(spark, at, stages.batch("new")))
    stages.do("merged", lambda: publish_merged(spark, at))
    stages.do("main", lambda: publish_main(spark, at))
    stages.do("vectors", lambda: publish_vectors(spark, at))
    return stages
