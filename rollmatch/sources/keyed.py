"""Backend tables bucketed and sorted by key, so that a batch comes to the table and not the table to the batch.

Each row carries its key as one text that is never null, and the table is written in a fixed number of buckets of it. A
join with a batch then shuffles the batch alone, into the same buckets; the table, however large, is read where it lies.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col, quoted
from rollmatch.operators.schema import align_schema, key_text
from rollmatch.session import cut
from rollmatch.sources.versions import VERSION_PREFIX, create_text, current_path, next_version, read_text, stamped

BUCKETS = 64
KEY = "__key"


def row_key(values: Sequence[Column]) -> Column:
    """One text, equal where all values are equal as texts, null equal to null; a digest if there are several values."""
    parts = [F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return parts[0] if len(parts) == 1 else F.sha2(F.concat(*parts), 256)


class KeyedTable:
    """A table below a folder, keyed by one trimmed column, or by the texts of several columns (rows as a whole)."""

    def __init__(self, spark: SparkSession, base: str, key: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.base, self.key = spark, base.rstrip("/"), list(key)
        create_text(spark, f"{self.base}/buckets", str(buckets))
        self.buckets = int(read_text(spark, f"{self.base}/buckets"))

    def _key_of(self, names: Sequence[str]) -> Column:
        return row_key([key_text(col(names[0]))] if len(names) == 1 else [col(n).cast("string") for n in names])

    def _name(self, path: str) -> str:
        return "keyed_" + hashlib.md5(path.encode()).hexdigest()

    def _table(self) -> DataFrame:
        """The current version with its key column; a session that does not know the table yet is told of it."""
        path = current_path(self.spark, self.base)
        if path == self.base:
            raise ValueError(f"no table in {self.base}")
        name = self._name(path)
        if not self.spark.catalog.tableExists(name):
            shape = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema)
            place = path.replace("'", "\\'")
            self.spark.sql(f"CREATE TABLE {name} ({shape}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{place}'")
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def exists(self) -> bool:
        return bool(stamped(self.spark, self.base, VERSION_PREFIX))

    def rows(self) -> DataFrame:
        return self._table().drop(KEY)

    def replace(self, rows: DataFrame) -> None:
        """Write the table anew, as a version beside the old one, which the rows may come from."""
        path = next_version(self.spark, self.base)
        keyed = rows.select("*", self._key_of(self.key).alias(KEY))
        (keyed.repartition(self.buckets, KEY).sortWithinPartitions(KEY).write.bucketBy(self.buckets, KEY).sortBy(KEY)
         .option("path", path).format("parquet").saveAsTable(self._name(path)))

    def unseen(self, batch: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
        """The batch's rows whose key the table lacks, duplicates too: `new_key_rows`, or for several columns `new_rows`."""
        held = self._table().select(F.col(KEY).alias("__held")).hint("merge")
        marked = batch.select("*", self._key_of(key or self.key).alias("__asked"))
        return marked.join(held, F.col("__asked") == F.col("__held"), "left_anti").drop("__asked")

    def append(self, batch: DataFrame) -> DataFrame:
        """Add the unseen rows in the table's layout; returns them. What was added before, in part or whole, stays out."""
        table = self._table()
        added = cut(align_schema(self.unseen(batch), [c for c in table.columns if c != KEY]))
        typed = added.select("*", self._key_of(self.key).alias(KEY)).select(*[
            col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        name = self._name(current_path(self.spark, self.base))
        typed.repartition(self.buckets, KEY).sortWithinPartitions(KEY).write.insertInto(name)
        return added

    def orphans(self, merged: DataFrame) -> DataFrame:
        """The table's rows whose key is not among the merged ones."""
        keys = merged.select(self._key_of(self.key).alias("__merged"))
        return self._table().hint("merge").join(keys, F.col(KEY) == F.col("__merged"), "left_anti").drop(KEY)

    def upsert(self, merged: DataFrame) -> None:
        """Replace the table by the merged rows and its orphans, keys trimmed: `upsert_with_orphans` as a new version."""
        trimmed = [t.select(*[key_text(col(c)).alias(c) if [c] == self.key else col(c) for c in t.columns])
                   for t in (merged, self.orphans(merged))]
        self.replace(trimmed[0].unionByName(trimmed[1], allowMissingColumns=True))

