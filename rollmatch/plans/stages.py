"""Stages of a job that can be stopped and run again."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from rollmatch.sources.versions import create_text, path_exists, read_text


class Stages:
    """The manifest of one run of a job: a marker per stage, made after all that the stage publishes.

    A stage names what it published (paths of versions, counts); a run that is started again takes finished stages from
    their markers and goes on with the first one that has none. What a stopped stage did before its marker is harmless to
    repeat: a table gets one more version of the same rows, a batch is appended once.
    """

    def __init__(self, spark: SparkSession, folder: str, run: str) -> None:
        self.spark, self.run = spark, run
        self.base = f"{folder.rstrip('/')}/{run}"
        self.made: list[str] = []

    def do(self, name: str, publish: Callable[[], dict[str, str]]) -> dict[str, str]:
        """What the stage published, in this run or before it was stopped."""
        marker = f"{self.base}/{name}.json"
        if not path_exists(self.spark, marker):
            text = json.dumps(publish())
            self.made.append(name)
            create_text(self.spark, marker, text)
        return json.loads(read_text(self.spark, marker))

    def batch(self, name: str) -> str:
        """The name under which a stage's rows are appended: the same in every attempt of the run."""
        return f"{self.run}-{name}"
