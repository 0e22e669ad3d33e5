"""Versions of a table below one folder, and small marker files.

A new version is written beside the old ones and counts from the moment its `_SUCCESS` file is there, which the writer
makes last. So readers never see half a table, a failed write leaves the table as it was, and a plan may read the version
that it is about to replace.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import SparkSession

# The time stamp text of a version and the prefixes of its folders.
STAMP = "%Y%m%d_%H%M%S"
VERSION_PREFIX = "v-"


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, fs = _at(spark, path)
    return fs.exists(where)


def names_below(spark: SparkSession, base: str, folders: bool = True) -> list[str]:
    """Names of the folders, or of the files, directly below a folder; none if it is missing."""
    where, fs = _at(spark, base)
    if not fs.exists(where):
        return []
    return [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory() == folders]


def stamped(spark: SparkSession, base: str, prefix: str) -> dict[datetime, str]:
    """Complete versions below a folder by time stamp; folders of other names, or half-written ones, are skipped."""
    found = {}
    for name in names_below(spark, base):
        match = re.fullmatch(re.escape(prefix) + r"(\d{8}_\d{6})", name)
        try:
            stamp = datetime.strptime(match.group(1), STAMP) if match else None
        except ValueError:
            continue
        if stamp and path_exists(spark, f"{base.rstrip('/')}/{name}/_SUCCESS"):
            found[stamp] = name
    return found


def next_version(spark: SparkSession, base: str, prefix: str = VERSION_PREFIX) -> str:
    """Path of a version later than all there are, complete or not. Two writers at once: the later one's write fails."""
    taken = names_below(spark, base)
    at = datetime.now().replace(microsecond=0)
    newest = max((s for s in stamped(spark, base, prefix)), default=at - timedelta(seconds=1))
    at = max(at, newest + timedelta(seconds=1))
    while f"{prefix}{at.strftime(STAMP)}" in taken:  # left by a write that failed
        at += timedelta(seconds=1)
    return f"{base.rstrip('/')}/{prefix}{at.strftime(STAMP)}"


def current_path(spark: SparkSession, base: str, prefix: str = VERSION_PREFIX) -> str:
    """Path of the newest complete version; the folder itself if it holds none, as an export made elsewhere."""
    found = stamped(spark, base, prefix)
    return f"{base.rstrip('/')}/{found[max(found)]}" if found else base


def drop_old_versions(spark: SparkSession, base: str, keep: int = 2, prefix: str = VERSION_PREFIX) -> None:
    """Delete all complete versions but the newest ones; a reader may still be at the one before the newest."""
    found = stamped(spark, base, prefix)
    for stamp in sorted(found)[:-keep]:
        where, fs = _at(spark, f"{base.rstrip('/')}/{found[stamp]}")
        fs.delete(where, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file, unless there is one: then False. The file system's create without overwrite decides, so of
    several writers one wins (HDFS and local disks; an object store needs conditional puts)."""
    where, fs = _at(spark, path)
    if fs.exists(where):
        return False
    try:
        out = fs.create(where, False)
    except Exception:
        if fs.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    where, fs = _at(spark, path)
    stream = fs.open(where)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text
