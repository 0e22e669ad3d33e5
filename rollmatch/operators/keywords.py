"""Containment join: each text with the first listed keyword it contains.

Matched by an equi-join on sampled substrings (anchors): a keyword and any text that contains it share at least one. A text's
anchors meet a bit array of all keywords' anchors before they become rows, so what is shuffled are true hits of anchors
and one in SPARE of the others.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.session import cut, spread_small

# Bits of the array per keyword, and its largest size in bits (16 MB): beyond 2 million keywords more anchors pass it.
SPARE = 64
MOST_BITS = 1 << 27

# (shortest keyword length, substring length, window): a window of `window` substrings of that length fits
# into every keyword at least that long, and its smallest hash is taken as an anchor of keyword and text. The substring is
# as much of the keyword as sampling allows: a short one stands in many texts that do not hold the keyword, and those are
# more with every keyword and every text.
SCHEMES = tuple((n, n, 1) for n in range(1, 8)) + ((8, 7, 2), (16, 12, 5), (24, 16, 9), (32, 20, 13))


def first_keyword(texts: DataFrame, text: str, keywords: DataFrame, keyword: str, position: str, key: str) -> DataFrame:
    """(key, text's first keyword by list position); texts without one are left out. `key` is unique per text."""
    listed = keywords.where(F.length(col(keyword)) > 0).groupBy(col(keyword).alias("word")).agg(
        F.min(col(position)).alias("pos"))
    source = texts.select(col(key).alias("id"), col(text).alias("text")).where(F.col("text").isNotNull())
    chosen, used = _chosen_anchors(listed)
    if not used:
        found = source.select("id", F.lit(None).cast("string").alias("word")).limit(0)
    else:
        source = spread_small(source, "id")
        candidates = _text_anchor_rows(source, chosen, used).join(chosen, "anchor").select("id", "word", "pos")
        found = candidates.join(source, "id").where(F.contains(F.col("text"), F.col("word"))).groupBy("id").agg(
            F.min_by("word", F.struct("pos", "word")).alias("word"))
    return found.select(F.col("id").alias(key), F.col("word").alias("keyword"))


def distinct_keywords(matches: DataFrame) -> DataFrame:
    return matches.select("keyword").distinct()


def _scheme(length: Column) -> Column:
    picked = F.lit(None).cast("int")
    for i, (least, _, _) in enumerate(SCHEMES):
        picked = F.when(length >= least, F.lit(i)).otherwise(picked)
    return picked


def _text_anchors(points: np.ndarray, gram: int, window: int) -> np.ndarray:
    """Distinct anchors of a text's code points: per window of substrings, the smallest substring hash."""
    if len(points) < gram + window - 1:
        return np.empty(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        hashed = np.full(len(points) - gram + 1, gram, dtype=np.uint64)
        for i in range(gram):
            hashed = hashed * np.uint64(1099511628211) + points[i:len(points) - gram + 1 + i]
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    # Minimum over a window by doubling: a window of 2n is two windows of n, overlapping as needed.
    lowest, done = hashed, 1
    while done < window:
        step = min(done, window - done)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        done += step
    return np.unique(lowest).view(np.int64)


def _anchors(schemes: list[int], bits: Broadcast | None = None) -> Column:
    """Anchors of each text by all given schemes; with a bit array, only those whose bit is set."""
    @F.pandas_udf("array<bigint>")
    def anchors(texts: pd.Series) -> pd.Series:
        known = None if bits is None else np.frombuffer(bits.value, dtype=np.uint8)

        def of(text: str) -> np.ndarray:
            points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            found = np.concatenate([_text_anchors(points, *SCHEMES[s][1:]) for s in schemes])
            if known is None:
                return found
            place = found & (8 * len(known) - 1)
            return found[(known[place >> 3] >> (place & 7)) & 1 == 1]

        return pd.Series([of(t) for t in texts], dtype=object)

    return anchors


def _chosen_anchors(listed: DataFrame) -> tuple[DataFrame, list[int]]:
    """(word, pos, anchor), written: each keyword's rarest anchor, which keeps keywords with a common beginning apart; and
    the schemes in use."""
    listed = listed.withColumn("own", _scheme(F.length("word")))
    used = sorted(r["own"] for r in listed.select("own").distinct().collect())
    if not used:
        return listed, used
    offered = reduce(DataFrame.unionByName, [
        listed.where(F.col("own") == s).select("word", "pos", F.explode(_anchors([s])("word")).alias("anchor")) for s in used])
    offered = cut(offered)
    frequency = offered.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    return cut(offered.join(frequency, "anchor").groupBy("word", "pos").agg(
        F.min_by("anchor", F.struct("n", "anchor")).alias("anchor"))), used


def _bit_array(chosen: DataFrame) -> bytes:
    """A bit per anchor, at its leading places; the array is a power of two of at least SPARE bits per keyword."""
    n_bits = 1 << 16
    wanted = SPARE * chosen.count()
    while n_bits < wanted and n_bits < MOST_BITS:
        n_bits *= 2
    place = F.col("anchor").bitwiseAND(n_bits - 1)
    # At most one row per byte of the array comes to the driver.
    held = chosen.groupBy(F.shiftright(place, 3).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1, CAST(anchor & 7 AS INT))")).alias("bits")).toPandas()
    array = np.zeros(n_bits // 8, dtype=np.uint8)
    array[held["at"].to_numpy()] = held["bits"].to_numpy()
    return array.tobytes()


def _text_anchor_rows(source: DataFrame, chosen: DataFrame, used: list[int]) -> DataFrame:
    """(id, anchor) of the texts' anchors that pass the bit array."""
    bits = source.sparkSession.sparkContext.broadcast(_bit_array(chosen))
    return source.select("id", F.explode(_anchors(used, bits)("text")).alias("anchor"))
