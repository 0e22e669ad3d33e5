"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.session import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of its component.

    Edges point from the larger node u to the smaller node v. Two steps alternate until every u has one v that points
    nowhere: first each edge is led on to the smallest node its v points to, then all that a u points to is tied to the
    smallest of them. Each round is written to the shared folder; only a yes or no comes to the driver. A hub's edges
    are joined, never gathered.
    """
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _settled(now):
        low = now.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        led = now.join(low, F.col("v") == F.col("w"), "left").select("u", F.coalesce("m", "v").alias("v"))
        least = led.groupBy("u").agg(F.min("v").alias("m"))
        tied = led.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cut(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _settled(now: DataFrame) -> bool:
    ends = now.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        now.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    sums = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not sums.filter("out > 1 OR (out = 1 AND into = 1)").limit(1).count()
