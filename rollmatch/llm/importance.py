"""Quality selection by importance resampling.

Words and word pairs are hashed into FEATURES buckets. Two generative models give each bucket a probability: the raw model
from all documents, the target model from documents labelled good. A document's log weight is the sum of log ratios
over its features. Adding Gumbel noise to the log weights and keeping the largest sums draws documents without
replacement in proportion to their weights.

The raw model counts every document. The target model is fitted on a bounded sample: TARGETS labelled documents by
smallest hash of their id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, unit_interval, unnested, with_fields
from rollmatch.llm.shingles import chunked_words, mixed
from rollmatch.session import cut

FEATURES = 1 << 14
TARGETS = 8192
PART = 256   # rows of a batch whose texts are in a worker's memory at a time
FEW = 4096  # values among which the last step of the search for the threshold sorts


def buckets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """Feature buckets of each text, one per word and one per pair of neighbouring words."""
    for words in chunked_words(texts):
        pairs = mixed(words[:-1] + np.uint64(1)) + words[1:]
        yield (mixed(np.concatenate([words, pairs])) % np.uint64(FEATURES)).astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of so many rows at most: a worker's memory follows their texts, not those of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fit(docs: DataFrame, good: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Log ratios of target and raw probability of each bucket. good: a column `good_id`, at most TARGETS rows.

    Each task adds up its own counts; one row per bucket comes to the driver.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("t"))
    rows = rows.join(F.broadcast(good.select(F.col("good_id").alias("id"), F.lit(True).alias("good"))), "id", "left")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(FEATURES, dtype=np.int64), np.zeros(FEATURES, dtype=np.int64)
        for batch in _parts(batches, PART):
            for found, is_good in zip(buckets(batch.column("t").to_pylist()), batch.column("good").to_pylist()):
                counts = np.bincount(found, minlength=FEATURES) if len(found) > FEATURES // 8 else None
                for sums in (raw, target) if is_good else (raw,):
                    if counts is None:
                        np.add.at(sums, found, 1)
                    else:
                        sums += counts
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.arange(FEATURES)), "raw": pa.array(raw),
                                          "target": pa.array(target)})

    sums = (rows.select("t", "good").mapInArrow(counted, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).orderBy("bucket").collect())
    raw = np.array([r.raw for r in sums] or [0] * FEATURES, dtype=float) + 1.0
    target = np.array([r.target for r in sums] or [0] * FEATURES, dtype=float)
    # The target model is smoothed with the raw one, so that what a small sample lacks by chance weighs little.
    target += raw / raw.sum() * max(target.sum() * 0.1, 1.0)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray, carry: Sequence[str], id_col: str = "doc_id", text_col: str = "text",
          seed: int = 1) -> DataFrame:
    """Carried columns under ROW, log_weight and noisy, its sum with Gumbel noise from id, text and seed."""
    own = F.struct(*[F.col(quoted(c)) for c in carry])
    rows = docs.select(own.alias(ROW), docs[text_col].alias("t"), F.xxhash64(docs[id_col], docs[text_col], F.lit(seed)).alias("h"))

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, PART):
            weight = np.array([ratios[found].sum() for found in buckets(batch.column("t").to_pylist())], dtype=float)
            noise = -np.log(-np.log(unit_interval(mixed(batch.column("h").to_numpy().astype(np.uint64)))))
            yield pa.RecordBatch.from_pydict({ROW: batch.column(ROW), "log_weight": pa.array(weight),
                                              "noisy": pa.array(weight + noise)})

    return rows.mapInArrow(weighed, with_fields(rows, [ROW], "log_weight double, noisy double"))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a written table's column, by counts over ever finer bins; never by sorting it all."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    x, above = F.col(column), 0
    while True:
        inside = values.filter(x.between(low, high))
        if low == high or inside.count() <= FEW:
            return float(sorted((r[0] for r in inside.select(column).limit(FEW).collect()), reverse=True)[k - above - 1]
                         if low < high else low)
        step = (high - low) / FEW
        place = F.least(((x - low) / step).cast("int"), F.lit(FEW - 1))
        bins = inside.groupBy(place.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("least"),
                                                    F.max(column).alias("most")).orderBy(F.desc("b")).collect()
        for b in bins:
            if above + b.n >= k:
                low, high = b.least, b.most
                break
            above += b.n


def resample(docs: DataFrame, labels: DataFrame, carry: Sequence[str] | None = None, id_col: str = "doc_id",
             text_col: str = "text", share: float | None = None, seed: int = 1) -> DataFrame:
    """Every input row with log_weight, noisy (double) and kept (boolean): the share of rows with the largest noisy values.

    labels: doc_id and quality (1: good); null ids and labels count for nothing. share: by default that of good ones among
    the labelled, 1 if none is labelled. A null or wordless text has log weight 0. Rows equal in id and text have
    equal values; rows tied at the threshold are all kept. Result columns replace those of the same name; an empty
    table gives none. carry: input columns to return, all by default.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality").distinct()
    if share is None:
        share = known.agg(F.avg((F.col("quality") == 1).cast("double"))).first()[0]
        share = 1.0 if share is None else share
    good = cut(known.filter("quality = 1").select(F.col("doc_id").alias("good_id"))
               .orderBy(F.xxhash64("good_id"), "good_id").limit(TARGETS))
    weighed = cut(weigh(docs, fit(docs, good, id_col, text_col), carry or docs.columns, id_col, text_col, seed))
    n = weighed.count()
    k = round(share * n)
    kept = F.col("noisy") >= kth_largest(weighed, "noisy", k) if k else F.lit(False)
    return unnested(weighed.withColumn("kept", kept), "log_weight", "noisy", "kept")
