"""Tables that only grow, by batches that are added once however often they are sent.

A batch's rows are written to a folder of their own and count from the moment their entry is in the log. Entries are
numbered, and a number can be taken once. A writer works out its rows against the entries it has seen and takes the number
after them: if another writer was faster, it looks again and works its rows out anew, so two batches that were
worked out against one state never both add a key. A batch that is in the log already adds nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rollmatch.sources.versions import create_text, names_below, read_text

TRIES = 20
WAITS = 30


@dataclass(frozen=True)
class Entry:
    number: int
    batch: str
    folder: str


class AppendLog:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> list[Entry]:
        """Committed batches in the order in which they were added."""
        return self._look()[0]

    def _look(self) -> tuple[list[Entry], int]:
        """Entries, and the last number that is taken."""
        names = sorted(n for n in names_below(self.spark, f"{self.path}/log", folders=False) if n.isdigit())
        found = []
        for name in names:
            text = read_text(self.spark, f"{self.path}/log/{name}")
            for _ in range(WAITS if name == names[-1] else 0):
                if text:
                    break
                time.sleep(0.1)  # its writer has taken the number and is about to write the entry
                text = read_text(self.spark, f"{self.path}/log/{name}")
            if text:  # else its writer died in between: the number stays unused
                found.append(Entry(int(name), **json.loads(text)))
        return found, int(names[-1]) if names else 0

    def read(self, entries: list[Entry] | None = None) -> DataFrame | None:
        """All rows of the given entries, in the layout of the first one; None when there are none."""
        entries = self.entries() if entries is None else entries
        if not entries:
            return None
        folders = [f"{self.path}/{e.folder}" for e in entries]
        return self.spark.read.schema(self.spark.read.parquet(folders[0]).schema).parquet(*folders)

    def before(self, entry: Entry) -> DataFrame | None:
        """The table as it was before a batch."""
        return self.read([e for e in self.entries() if e.number < entry.number])

    def append(self, rows: Callable[[DataFrame | None], DataFrame], batch: str | None = None) -> Entry:
        """Add what `rows` makes of the table as it is (None at first).

        A batch that the log holds is not made again: the entry that it made then is returned.
        """
        batch = batch or uuid.uuid4().hex
        for _ in range(TRIES):
            seen, taken = self._look()
            held = [e for e in seen if e.batch == batch]
            if held:
                return held[0]
            table = self.read(seen)
            made = rows(table) if table is None else _laid_out(rows(table), table)
            folder = f"data/{uuid.uuid4().hex}"
            made.write.parquet(f"{self.path}/{folder}")
            if create_text(self.spark, f"{self.path}/log/{taken + 1:012d}", json.dumps({"batch": batch, "folder": folder})):
                return Entry(taken + 1, batch, folder)
        raise RuntimeError(f"{self.path}: other writers were faster {TRIES} times")


def _laid_out(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The table's columns and types; a type that does not fit is an error of the cast."""
    if rows.schema == table.schema:
        return rows
    if rows.columns != table.columns:
        raise ValueError(f"columns {rows.columns} for a table of {table.columns}")
    return rows.select(*[rows[f"`{f.name.replace('`', '``')}`"].cast(f.dataType).alias(f.name) for f in table.schema.fields])


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    table = AppendLog(spark, path).read()
    if table is None:
        raise ValueError(f"no batches in {path}")
    return table
