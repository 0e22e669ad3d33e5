"""Language identification by rank-order profiles of character n-grams.

A profile is the TOP most frequent n-grams (one to three characters, lower case, everything but letters one blank) in
order of frequency. A text is given the language whose profile is nearest to its own: the distance is the sum over the
text's n-grams of how far their ranks lie apart, TOP for one that the profile does not have.

Profiles are learned from a bounded sample of labelled documents, SAMPLE per language by smallest text hash; every text
is identified whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, unnested, with_fields
from rollmatch.session import cut

TOP = 300
SLICES = 16
SAMPLE = 400
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes of a text's n-grams, ascending, and their counts; none if the text has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    blank = np.uint64(32)
    points = np.concatenate([[blank], np.where(_letters()[points], points, blank), [blank]]).astype(np.uint64)
    points = points[np.concatenate([[True], (points[1:] != blank) | (points[:-1] != blank)])]  # blanks in a row are one
    one = points[points != blank]
    if not len(one):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    two = points[:-1] << np.uint64(21) | points[1:]
    three = two[:-1] << np.uint64(21) | points[2:]
    return np.unique(np.concatenate([one, two, three]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent codes, in order; of equal counts the smaller code comes first."""
    if len(codes) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")][:top]


class Profiles:
    """Ranks of n-grams in each language."""

    def __init__(self, languages: dict[str, np.ndarray]) -> None:
        self.names = sorted(languages)
        self.codes = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *languages.values()]))
        self.ranks = np.full((len(self.names), len(self.codes) + 1), TOP, dtype=np.int64)  # the last: in no profile
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.codes, languages[name])] = np.arange(len(languages[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: how much nearer it is than the second, as a share of the second's distance."""
        codes, counts = grams(text)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(codes, counts)
        at = np.searchsorted(self.codes, own)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != own)] = len(self.codes)
        known = self.ranks[:, at]
        far = np.where(known == TOP, TOP, np.abs(known - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(far))
        second = np.partition(far, 1)[1] if len(far) > 1 else TOP * len(own)
        return self.names[best], float((second - far[best]) / second) if second else 0.0


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Profiles:
    """Profiles from at most `sample` texts of each language; rows of null language or text are left out.

    Which texts are taken is settled on hashes alone. TOP rows per language come to the driver.
    """
    rows = labelled.select(labelled[text_col].alias("t"), labelled[lang_col].cast("string").alias("lang"),
                           F.xxhash64(labelled[text_col]).alias("h")).filter("t IS NOT NULL AND lang IS NOT NULL")
    # The smallest hashes of each slice of a language first: a language of a third of all texts is many windows.
    slice_ = F.pmod(F.xxhash64("h"), F.lit(SLICES))
    some = rows.select("lang", "h").distinct().withColumn(
        "k", F.row_number().over(Window.partitionBy("lang", slice_).orderBy("h"))).filter(F.col("k") <= sample)
    first = Window.partitionBy("lang").orderBy("h")
    picked = cut(some.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= sample).select("lang", "h"))
    # sample rows per language; languages are few, and the size is checked.
    chosen = rows.join(F.broadcast(picked) if picked.count() <= 1_000_000 else picked, ["lang", "h"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, codes, counts = [], [], []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
                code, count = grams(text)
                langs += [lang] * len(code)
                codes.append(code.astype(np.int64))
                counts.append(count)
            empty = np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()),
                                              "code": pa.array(np.concatenate([empty, *codes])),
                                              "n": pa.array(np.concatenate([empty, *counts]))})

    sums = (chosen.dropDuplicates(["lang", "h"]).select("lang", "t").mapInArrow(counted, "lang string, code long, n long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    best = sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code")))
    found: dict[str, list[tuple[int, int]]] = {}
    for r in best.filter(F.col("rank") <= TOP).select("lang", "rank", "code").collect():
        found.setdefault(r.lang, []).append((r.rank, r.code))
    return Profiles({k: np.array([c for _, c in sorted(v)], dtype=np.uint64) for k, v in found.items()})


def held_out(doc_id: Column) -> Column:
    """The fold that is not learned from: crc32 of the id's digits, modulo 4, is 2. A null id is in no such fold."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, profiles: Profiles, carry: Sequence[str] | None = None, text_col: str = "text") -> DataFrame:
    """Every input row with lang_pred (string) and score (double, 0 to 1).

    A text that is null or has no letter is `und` with score 0, as is any text if nothing was learned. Equal distances
    go to the first language by name. Result columns replace those of the same name; an empty table gives none.
    carry: input columns to return, all by default.
    """
    own = F.struct(*[F.col(quoted(c)) for c in carry or docs.columns])
    rows = docs.select(own.alias(ROW), docs[text_col].alias("t"))

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [profiles.predict(t.as_py()) for t in batch.column("t")]
            yield pa.RecordBatch.from_pydict({ROW: batch.column(ROW), "lang_pred": pa.array([x for x, _ in out], pa.string()),
                                              "score": pa.array([x for _, x in out], pa.float64())})

    schema = with_fields(rows, [ROW], "lang_pred string, score double")
    return unnested(rows.mapInArrow(predicted, schema), "lang_pred", "score")
