"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words. A document of the source should appear target / source size times: the whole
part for certain, the fraction by rounding. Rounding is dependent: two fractions meet, and words move from one to the
other at random, keeping both expectations and their sum of words, until one of them is 0 or 1. So a source's words end
within one document of its target, while each document appears as often as it should on average.

Documents meet longest first, so that the one left over is mostly a short one. The meetings form a reduction tree. Documents of a source are dealt by hash to leaves of some LEAF_ROWS rows;
a leaf settles all but one of its documents. Those left over meet FAN_IN at a time, level by level, until
one is left for each source. The random numbers are hashes of seed, document and level, so reruns agree.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, all_of, unnested, word_count
from rollmatch.session import cut

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
LEAF_ROWS = 8192
FAN_IN = 64


def targets(sizes: Sequence[int], weights: Sequence[float], share: float = 1.0, most: float = MOST_COPIES) -> list[float]:
    """Words wanted of each source: share of all words by weight, none above `most` times the source's own size.

    What a source cannot give is dealt again by weight among those still below their limit.
    """
    left, out = share * sum(sizes), [0.0] * len(sizes)
    open_ = [i for i, s in enumerate(sizes) if s > 0]
    while open_ and left > 0:
        each = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if each * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = each * weights[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            left -= out[i]
            open_.remove(i)
    return out


def settle(parts: np.ndarray, words: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Round fractions pairwise, in the given order. Returns the fractions, all 0 or 1 but at most one, and its place
    (-1: none is left)."""
    parts, held = parts.copy(), -1
    for i in range(len(parts)):
        if not 0.0 < parts[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        a, b, ratio = parts[held], parts[i], words[held] / words[i]
        up = min(1.0 - a, b / ratio)        # the held document may gain so much, the other losing up * ratio
        down = min(a, (1.0 - b) / ratio)
        if draws[i] * (up + down) < down:
            a, b = a + up, b - up * ratio
        else:
            a, b = a - down, b + down * ratio
        parts[held], parts[i] = (round(x) if min(abs(x), abs(1 - x)) < 1e-9 else x for x in (a, b))
        held = held if 0.0 < parts[held] < 1.0 else i if 0.0 < parts[i] < 1.0 else -1
    return parts, held


def draws_of(keys: Sequence[str], seed: int, level: int) -> np.ndarray:
    return np.array([(zlib.crc32(f"{seed}:{level}:{k}".encode()) + 0.5) / 2 ** 32 for k in keys])


def _sources(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source, nulls last, with its share of the mix; one row per source is all that the driver sees."""
    found = rows.groupBy("source_key").agg(F.count("*").alias("n"), F.sum("words").alias("source_size")).collect()
    found.sort(key=lambda r: (r.source_key is None, r.source_key or ""))
    sizes = [int(r.source_size) for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], share, most)
    return rows.sparkSession.createDataFrame(
        [(i, r.source_key, s, t, t / s if s else 0.0, max(1, math.ceil(r.n / LEAF_ROWS)))
         for i, (r, s, t) in enumerate(zip(found, sizes, wanted))],
        "sid long, known string, source_size long, target double, rate double, leaves long")


def _round_leaves(rows: DataFrame, seed: int) -> DataFrame:
    """One row per leaf: the copies of its documents, longest first, and the fraction of the one left over."""

    def leaf(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["words", "pick", "key"], ascending=[False, True, True], kind="stable")
        words, rate = group["words"].to_numpy(dtype=float), group["rate"].to_numpy()
        whole = np.floor(rate + 1e-12)
        parts = np.where(words > 0, rate - whole, 0.0)
        parts[np.abs(parts) < 1e-9] = 0.0
        parts, held = settle(parts, np.maximum(words, 1.0), draws_of(group["key"], seed, 0))
        part = parts[held] if held >= 0 else 0.0
        parts[held] = 0.0 if held >= 0 else parts[held]
        return pd.DataFrame({"sid": group["sid"].iloc[:1], "leaf": group["leaf"].iloc[:1], "held": held, "part": part,
                             "words": int(words[held]) if held >= 0 else 0,
                             "copies": [(whole + np.round(parts)).astype("int32")]})

    return rows.groupBy("sid", "leaf").applyInPandas(
        leaf, "sid long, leaf long, held int, part double, words long, copies array<int>")


def _meeting(seed: int, level: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def meet(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["words", "leaf"], ascending=[False, True]).reset_index(drop=True)
        keys = [f"{s}:{x}" for s, x in zip(group["sid"], group["leaf"])]
        parts, held = settle(group["part"].to_numpy(), group["words"].to_numpy(dtype=float), draws_of(keys, seed, level))
        if last and held >= 0:
            parts[held], held = float(draws_of([keys[held]], seed, -1)[0] < parts[held]), -1
        return group.assign(part=parts, open=np.arange(len(group)) == held)

    return meet


def _round_tree(left: DataFrame, seed: int) -> DataFrame:
    """For each leaf with a document left over: `extra`, 1 if that document appears once more, else 0."""
    spark, done, level = left.sparkSession, [], 0
    left = cut(left.select("sid", "leaf", F.col("leaf").alias("node"), "part", "words"))
    while left.count():
        # Once every source has a single node, what is left of it is rounded by itself.
        last = level > 0 and left.agg(F.max("node")).first()[0] == 0
        level += 1
        up = left.withColumn("node", F.expr(f"node div {FAN_IN}"))
        met = cut(up.groupBy("sid", "node").applyInPandas(
            _meeting(seed, level, last), "sid long, leaf long, node long, part double, words long, open boolean"))
        done.append(met.filter("not open").select("sid", "leaf", F.round("part").cast("int").alias("extra")))
        left = met.filter("open").drop("open")
    return all_of(done) if done else spark.createDataFrame([], "sid long, leaf long, extra int")


def _planned(docs: DataFrame, carried: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", weights: Sequence[float] = WEIGHTS, share: float = 1.0,
             most: float = MOST_COPIES, seed: int = 1) -> DataFrame:
    """The carried columns under ROW, with size, source_size, target and copies.

    A leaf's decisions are one array, met by (source, leaf) and read by place: rows are dealt once, with what they carry.
    """
    key = F.concat_ws("|", docs[id_col].cast("string"), F.hex(F.xxhash64(docs[text_col])))
    own = F.struct(*[F.col(quoted(c)) for c in carried])
    # Words are counted once; the sums, the leaves and the result read the written table.
    rows = cut(docs.select(own.alias(ROW), word_count(docs[text_col]).alias("words"),
                           docs[source_col].cast("string").alias("source_key"), key.alias("key")))
    sources = cut(_sources(rows, weights, share, most))
    # One row per source, sent to the tasks once their number is known to be small.
    small = F.broadcast(sources) if sources.count() <= 100_000 else sources
    rows = (rows.join(small, F.col("source_key").eqNullSafe(F.col("known")))
            .withColumn("pick", F.xxhash64("key", F.lit(seed)))
            .withColumn("leaf", F.pmod(F.xxhash64("key", F.lit(seed + 1)), "leaves")))
    leaves = cut(_round_leaves(rows.select("sid", "leaf", "pick", "key", "words", "rate"), seed))
    extra = _round_tree(leaves.filter("held >= 0"), seed)
    decided = leaves.select("sid", "leaf", "held", "copies").join(extra, ["sid", "leaf"], "left")
    place = F.row_number().over(Window.partitionBy("sid", "leaf").orderBy(F.desc("words"), "pick", "key")) - 1
    out = rows.withColumn("place", place).join(decided, ["sid", "leaf"])
    copies = F.get("copies", "place") + F.when(F.col("place") == F.col("held"), F.coalesce("extra", F.lit(0))).otherwise(0)
    return out.select(ROW, F.col("words").alias("size"), "source_size", "target", copies.cast("long").alias("copies"))


def plan_mix(docs: DataFrame, carry: Sequence[str] | None = None, **options) -> DataFrame:
    """Every input row with size, source_size (long), target (double) and copies (long, 0 to `most`).

    size: words of the text, a null text having none. A null source is a source of its own, the last. A document
    without words has the whole part of its source's rate as copies. Repeated rows are rounded one by one. Result columns
    replace those of the same name; an empty table gives none. carry: input columns to return, all by default; a text
    that is not carried is never shuffled.
    """
    return unnested(_planned(docs, carry or docs.columns, **options), "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each input row as many times as the plan says, with the input's columns only."""
    planned = _planned(docs, docs.columns, **options).filter("copies > 0")
    return planned.select(F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))), ROW).select(f"{ROW}.*")
