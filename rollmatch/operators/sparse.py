"""Exact top-k search over term weights, without folding texts into dense vectors.

Weights are not negative. For each query a lower bound of its k-th best score is found from few rows first: the k
heaviest items of each of its terms. A query's terms are then put in order of what they can add at most (its weight times
the term's greatest weight in any item); as long as the sum of the smallest ones stays below that bound, an item that
holds only such terms cannot be among the best. So candidates come from the other terms alone, and the frequent terms are
only looked up for candidates that can still reach the bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.session import cut

# Decimals that count when scores are compared, and what rounding can do to a bound.
COMPARED, SLACK = 9, 1e-9


def unit_weights(weights: DataFrame, key: str, terms: DataFrame | None = None) -> DataFrame:
    """(key, term, w): weights of each text divided by their length; terms of weight zero are left out.

    The weights are read twice. With `terms`, only rows of these terms are made, each by the length of its whole text.
    """
    positive = weights.where("weight > 0")
    lengths = positive.groupBy(col(key).alias("__k")).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("__n"))
    if terms is not None:
        positive = positive.join(terms, "term", "left_semi")
    return positive.join(lengths, col(key).eqNullSafe(F.col("__k"))).select(
        col(key), "term", (F.col("weight") / F.col("__n")).alias("w"))


def lower_bounds(asked: DataFrame, held: DataFrame, k: int) -> DataFrame:
    """(q, bound): the k-th best sum over the heaviest items of the query's terms, which no better score can be below.

    asked: (q, term, w), held: (i, term, v). A query with fewer than k such items has no bound.
    """
    heaviest = held.withColumn("place", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("v"), "i"))).where(
        F.col("place") <= k)
    part = asked.join(heaviest, "term").groupBy("q", "i").agg(F.sum(F.col("w") * F.col("v")).alias("s"))
    best = part.withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "i")))
    return best.where(F.col("place") == k).select("q", F.col("s").alias("bound"))


def with_reach(asked: DataFrame, held: DataFrame, bounds: DataFrame) -> DataFrame:
    """(q, term, w, bound, reach, rest): `reach` is what the query's terms up to this one, smallest first, can add at most;
    a term is needed for candidates if reach does not stay below the bound. `rest` is the reach of all that are not."""
    most = held.groupBy("term").agg(F.max("v").alias("most"))
    terms = asked.join(most, "term").join(bounds, "q", "left").withColumn("adds", F.col("w") * F.col("most"))
    upward = Window.partitionBy("q").orderBy("adds", "term").rowsBetween(Window.unboundedPreceding, 0)
    terms = terms.withColumn("reach", F.sum("adds").over(upward)).withColumn(
        "needed", F.col("bound").isNull() | (F.col("reach") >= F.col("bound") - SLACK))
    return terms.withColumn("rest", F.coalesce(F.max(F.when(~F.col("needed"), F.col("reach"))).over(
        Window.partitionBy("q")), F.lit(0.0))).drop("adds", "most")


def nearest_by_terms(queries: DataFrame, items: DataFrame, k: int, query_id: str, item_id: str) -> DataFrame:
    """The k nearest items per query by the cosine of their term weights: (query id, rank from 1, near item id, score).

    Both sides are (id, term, weight) rows, the queries' in the weights of the items' corpus (`fit_terms`, `weigh_terms`).
    Only items with a term in common are found; equal scores go to the smaller id. A null id is no query and no item.
    """
    asked = cut(unit_weights(queries.where(col(query_id).isNotNull()), query_id).select(
        col(query_id).alias("q"), "term", "w"))
    # Of the items, only terms that are asked for can add to a score.
    weights = cut(items.where(col(item_id).isNotNull() & (F.col("weight") > 0)))
    held = cut(unit_weights(weights, item_id, asked.select("term").distinct()).select(
        col(item_id).alias("i"), "term", F.col("w").alias("v")))
    terms = cut(with_reach(asked, held, lower_bounds(asked, held, k)))
    first = terms.where("needed").join(held, "term").groupBy("q", "i").agg(
        F.sum(F.col("w") * F.col("v")).alias("part"), F.max("rest").alias("rest"), F.max("bound").alias("bound"))
    able = cut(first.where(F.col("bound").isNull() | (F.col("part") + F.col("rest") >= F.col("bound") - SLACK)).select(
        "q", "i", "part"))
    more = able.join(terms.where("NOT needed").select("q", "term", "w"), "q").join(held, ["i", "term"]).groupBy("q", "i").agg(
        F.sum(F.col("w") * F.col("v")).alias("more"))
    scored = able.join(more, ["q", "i"], "left").select("q", "i", (F.col("part") + F.coalesce("more", F.lit(0.0))).alias("score"))
    order = Window.partitionBy("q").orderBy(F.round("score", COMPARED).desc(), "i")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_id), "rank", F.col("i").alias(f"near_{item_id}"), "score")
