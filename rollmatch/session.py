"""Session set-up, the shared working folder and table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from rollmatch.functions.columns import quoted

_SHIPPED: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more shuffle later in the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "rollmatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship(session)
    return session


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks import it wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="rollmatch-code-"), "rollmatch.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    A local session that names none (a test) gets a folder of its own; on a cluster, where each machine would write to
    a disk of its own, that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    own = tempfile.mkdtemp(prefix="rollmatch-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/rollmatch/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once its jobs have written their results."""
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def cut(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    For a table that several later steps read: it is computed once, its lineage ends here, and a lost executor
    costs no recomputation. The columnar file lets each reader take only its columns.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def short_methods(spark: SparkSession) -> Iterator[None]:
    """For writing wide rows. The JVM compiles no method of more than 8,000 bytes, so a stage that Spark would make one longer
    method of runs many times slower. Below this limit Spark puts such a stage together from short methods."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread_small(df: DataFrame, key: str, bound: int = 256 * 1024 * 1024) -> DataFrame:
    """Spread a table of checked small size over all cores before an expensive step per row.

    A small table may be a single split, which one task would work off alone. A larger one has splits enough and
    is left as it is, so no big table is ever shuffled for this.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, quoted(key)) if size <= bound else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
