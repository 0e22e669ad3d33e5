"""Exact deduplication against a persistent digest index. DataFrame functions only.

The index is a table bucketed and sorted by the SHA-256 digest of the normalised text, in a folder of its own: it outlives
the session, which only names it in its catalog. A load is reduced to one row per digest, sort-merge anti-joined with the
index and appended, so the index is never shuffled and a load that is repeated adds nothing.

Of equal texts the best row stays: the most code points before normalising, then the smallest id (null last), then the
earliest load and row. A later load may hold a better row than the index: it is appended as well, and the best entry of a
digest stands. After any number of loads the index says the same as after one load of all rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.session import cut

BUCKETS = 64
BLANKS = " \t\n\x0b\f\r"
BEST = "struct<shorter: bigint, no_id: boolean, id: {kind}, load: string, row: bigint>"


class DigestIndex:
    """The index below a folder: its buckets are fixed when it is made, and read from the folder afterwards."""

    def __init__(self, spark: SparkSession, base: str, buckets: int = BUCKETS, id_type: str = "bigint") -> None:
        self.spark = spark
        found = [m for m in (re.fullmatch(r"buckets-(\d+)", n) for n in _names(spark, base)) if m]
        self.buckets = int(found[0].group(1)) if found else buckets
        self.path = f"{base.rstrip('/')}/buckets-{self.buckets}"
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        place = self.path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest binary, best {BEST.format(kind=id_type)}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'")
        spark.catalog.refreshTable(self.table)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def standing(self) -> DataFrame:
        """(digest, best): one row per digest; the buckets already hold all of a digest, so nothing is shuffled."""
        return self.entries().groupBy("digest").agg(F.min("best").alias("best"))

    def fresh(self, rows: DataFrame) -> DataFrame:
        """(digest, best) of a load that the index holds nothing as good for, by a sort-merge anti-join."""
        new = rows.groupBy("digest").agg(F.min("best").alias("best")).alias("new")
        held = self.entries().hint("merge").alias("held")
        return new.join(held, F.expr("new.digest = held.digest AND held.best <= new.best"), "left_anti")

    def add(self, rows: DataFrame) -> DataFrame:
        """Append what a load brings; returns the appended entries. The same load again adds nothing."""
        added = cut(self.fresh(rows))
        (added.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table))
        self.spark.catalog.refreshTable(self.table)
        return added


def _names(spark: SparkSession, base: str) -> list[str]:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def normalised(text_col: str) -> F.Column:
    """The text without blanks (space, and tab to carriage return); a null text is empty."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", load: str = "") -> DataFrame:
    """(digest, best) per row, written: digest as 32 bytes, best = what ranks the row among equal texts.

    A load's rows are numbered, so that of repeated rows just one is the best. A null or blank text has the digest of
    the empty text; a null id ranks after all others.
    """
    n_chars = F.length(F.coalesce(col(text_col).cast("string"), F.lit(""))).cast("long")
    return cut(docs.select(
        F.unhex(F.sha2(normalised(text_col).cast("binary"), 256)).alias("digest"),
        F.struct((-n_chars).alias("shorter"), col(id_col).isNull().alias("no_id"), col(id_col).alias("id"),
                 F.lit(load).alias("load"), F.monotonically_increasing_id().alias("row")).alias("best")))


def membership(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Per row of `digests`: doc_id, keep_id, group_size (rows of that digest here), kept, text_sha256.

    Sizes are counted before the shuffle. The last join meets a digest's rows with one row, so a group that holds a third
    of all rows is split by Spark's skew join; both sides are plain tables for that reason. An empty table gives none.
    """
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    stays = cut(sizes.join(index.standing(), "digest")).withColumnRenamed("best", "stays")
    return rows.join(stays, "digest").select(
        F.col("best.id").alias("doc_id"), F.col("stays.id").alias("keep_id"), "group_size",
        F.col("best").eqNullSafe(F.col("stays")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ids of a load's rows that stay, after adding the load to the index."""
    rows = digests(docs, id_col, text_col)
    index.add(rows)
    return membership(rows, index).where("kept").select(F.col("doc_id").alias(id_col))
