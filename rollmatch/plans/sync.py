"""Append-only syncs into the backend tables, each with its count report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollmatch.operators.merge import new_key_rows, new_rows, sync_aligned
from rollmatch.operators.rollup import count_report
from rollmatch.operators.schema import align_schema
from rollmatch.plans import layouts as L
from rollmatch.session import cut
from rollmatch.sources.appendlog import AppendLog, Entry
from rollmatch.sources.sinks import append_rows


def sync_filled(filled: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows no target row equals, report)."""
    added = new_rows(filled, target)
    return added, count_report(target, added, filled, L.KEY)


def sync_participants(final: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of unseen keys in the target's layout, report)."""
    added = sync_aligned(final, target, L.KEY)
    return added, count_report(target, added, final, L.KEY)


def sync_predictions(results: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of unseen keys in the source's layout, to be appended by position, report)."""
    added = new_key_rows(results, target, L.KEY)
    return added, count_report(target, added, results, L.KEY)


def _report(log: AppendLog, entry: Entry, source: DataFrame) -> DataFrame:
    """The count report of a batch, which is the same when the batch is sent again."""
    added = log.read([entry])
    before = log.before(entry)
    tables = [t.withColumnRenamed(t.columns[0], L.KEY) for t in (added.limit(0) if before is None else before, added)]
    return cut(count_report(*tables, source, L.KEY))


def append_filled(filled: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Append the filled rows that no row of the table equals, in the table's layout; returns the report."""
    log = AppendLog(filled.sparkSession, path)
    entry = log.append(lambda target: filled if target is None else align_schema(new_rows(filled, target), target.columns), batch)
    return _report(log, entry, filled)


def append_participants(final: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Append the participants whose key the table lacks, in the table's layout; returns the report."""
    log = AppendLog(final.sparkSession, path)
    entry = log.append(lambda target: final if target is None else sync_aligned(final, target, L.KEY), batch)
    return _report(log, entry, final)


def append_predictions(results: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Append the predictions of unseen keys to their table, by position; returns the report.

    The table's first column is its key, whatever its heading. The rows are worked out against the table as it is when
    they are added.
    """
    log = AppendLog(results.sparkSession, path)
    entry = append_rows(results, path, batch=batch, only=lambda target: new_key_rows(
        results, target.withColumnRenamed(target.columns[0], L.KEY), L.KEY))
    return _report(log, entry, results)
