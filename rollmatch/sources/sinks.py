"""Writing tabs, CSV files, appended rows and versioned tables.

A table that is replaced gets a new version, see `versions`; one that grows is an append log, see `appendlog`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, cols, quoted
from rollmatch.operators.merge import strict_append_rows
from rollmatch.session import cut, short_methods
from rollmatch.sources.appendlog import AppendLog, Entry
from rollmatch.sources.tabs import CSV_OPTIONS
from rollmatch.sources.versions import STAMP, VERSION_PREFIX, names_below, next_version, stamped

# The prefixes of the folders of results and indexes.
RESULTS_PREFIX = "results-"
INDEX_PREFIX = "index-"
NULL_RUN = "__HIVE_DEFAULT_PARTITION__"


def as_cells(df: DataFrame, leave_out: Sequence[str] = ()) -> DataFrame:
    """Every column as text, null as an empty text."""
    return df.selectExpr(*[
        f"coalesce(CAST({quoted(c)} AS STRING), '') AS {quoted(c)}" for c in df.columns if c not in leave_out])


def _in_order(df: DataFrame, order: str | None) -> DataFrame:
    return df if order is None else df.orderBy(col(order))


def _csv(df: DataFrame, base: str) -> str:
    path = next_version(df.sparkSession, base)
    with short_methods(df.sparkSession):
        df.write.options(**CSV_OPTIONS, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return path


def write_tab(df: DataFrame, base: str, order: str | None = None) -> str:
    """Replace a tab: header and all rows, in row order when an order column is named (it is not written).

    The rows may come from the tab itself. Returns the path of the new version, which `read_tab` finds below `base`.
    """
    return _csv(as_cells(_in_order(df, order), [order] if order else ()), base)


def write_csv(df: DataFrame, bases: Sequence[str], order: str | None = None) -> list[str]:
    """The same table to each CSV folder, computed once, each as a new version; returns the versions' paths."""
    table = cut(df) if len(bases) > 1 else df
    return [_csv(_in_order(table, order).select(*cols(c for c in df.columns if c != order)), base) for base in bases]


def append_rows(df: DataFrame, path: str, by_position: bool = True, batch: str | None = None,
                only: Callable[[DataFrame], DataFrame] | None = None) -> Entry:
    """Add rows to an append log: by position (names ignored), or by name.

    A shorter row is filled with nulls; one wider than the table is an error. The first batch gives the layout. A batch
    of the same name is added once, however often it is sent. `only` makes the rows to add from the table as it is.
    """
    def laid_out(target: DataFrame | None) -> DataFrame:
        if target is None:
            return df
        source = only(target) if only else df
        if not by_position:
            return source.select(*cols(target.columns))
        if len(source.columns) > len(target.columns):
            raise ValueError(f"{len(source.columns)} columns do not fit a table of {len(target.columns)}")
        have = dict(zip(target.columns, source.columns))
        return source.select(*[col(have[t]).alias(t) if t in have else F.lit(None).alias(t) for t in target.columns])

    return AppendLog(df.sparkSession, path).append(laid_out, batch)


def strict_append(df: DataFrame, path: str, columns: Sequence[str], batch: str | None = None) -> Entry:
    """Append the rows whose first column the table lacks, in exactly the given columns."""
    return AppendLog(df.sparkSession, path).append(lambda target: strict_append_rows(df, target, columns), batch)


def write_snapshot(df: DataFrame, base: str, prefix: str = RESULTS_PREFIX, at: datetime | None = None) -> str:
    """Write a new time-stamped version and return its path."""
    path = f"{base.rstrip('/')}/{prefix}{(at or datetime.now()).strftime(STAMP)}"
    df.write.parquet(path)
    return path


def snapshot_path(spark: SparkSession, base: str, prefix: str = RESULTS_PREFIX, version: str = "latest") -> str | None:
    """Path of the newest version, or of the named one (an error if absent); None when there are none."""
    found = stamped(spark, base, prefix)
    if not found:
        return None
    if version == "latest":
        return f"{base.rstrip('/')}/{found[max(found)]}"
    for stamp, name in found.items():
        if stamp.strftime(STAMP) == version:
            return f"{base.rstrip('/')}/{name}"
    raise ValueError(f"no version {version} below {base}")


def read_snapshot(spark: SparkSession, base: str, prefix: str = RESULTS_PREFIX, version: str = "latest") -> DataFrame:
    path = snapshot_path(spark, base, prefix, version)
    if path is None:
        raise ValueError(f"no versions below {base}")
    return spark.read.parquet(path)


def write_run_table(df: DataFrame, path: str, run: str) -> None:
    """Many runs in one table, a folder per run; a run that holds most rows is spread over several tasks."""
    df.hint("rebalance", run).write.mode("overwrite").partitionBy(run).parquet(path)


def read_latest_run(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The rows of the greatest run; rows of a null run are in none.

    Runs are told by their folders, so no other run's files are opened, and compared as values of the run column's
    type: 10 comes after 9. An escaped name stands for its value.
    """
    prefix = f"{run}="
    names = [name for name in names_below(spark, path) if name.startswith(prefix)]
    kind = spark.read.parquet(path).schema[run].dataType if names else None
    values = [(name, unquote(name.removeprefix(prefix))) for name in names if name != prefix + NULL_RUN]
    if not values:
        raise ValueError(f"no runs below {path}")
    newest = spark.createDataFrame(values, "name string, value string").agg(
        F.max_by("name", F.col("value").cast(kind))).first()[0]
    rows = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{newest}")
    return rows.withColumn(run, col(run).cast(kind))


def replace_table(df: DataFrame, base: str, order: str | None = None) -> str:
    """Overwrite a table as a new version next to the old ones, so the plan may read the current version.

    Readers take the newest complete version; a failed write leaves the table as it was.
    """
    path = next_version(df.sparkSession, base)
    _in_order(df, order).write.parquet(path)
    return path


def read_table(spark: SparkSession, base: str) -> DataFrame:
    return read_snapshot(spark, base, VERSION_PREFIX)


def write_vectors(nodes: DataFrame, base: str) -> str:
    """Replace the vector table by the given nodes."""
    return replace_table(nodes, base)
