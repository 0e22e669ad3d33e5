"""Order-independent document fingerprints by a homomorphic multiset hash.

A paragraph (a line that is not empty; of a line over LONG characters, each of the pieces that it falls into at
content-defined places) is hashed to a wide vector, and a document's fingerprint is the sum of its
paragraphs' vectors, each place modulo a power of two. So the order of paragraphs does not matter, a paragraph is added or
taken away without the others, and fingerprints of parts add up to that of the whole.

The vector has three parts: 1 in a counter (modulo 2^64); four dense places modulo 2^64, which tell different multisets
apart; and LEVELS times LANES places modulo 2^16. Level k takes each paragraph with probability 4^-k, by its hash, and a
paragraph touches one lane in each level that takes it. Two documents differ in few lanes of a level if few of the
paragraphs in it differ, so the share of equal lanes, in the finest level where enough are equal, estimates how many
paragraphs they share.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, unnested, with_fields
from rollmatch.session import cut

LANES = 64
LEVELS = 8     # the coarsest tells some two million differing paragraphs
FEW_EQUAL = 8  # with fewer equal lanes a level says too little
LONG = 256     # characters; a longer line is cut after about every 32nd
REACH = 8      # characters that decide on a cut
DENSE = 4
_DIGEST = 8 * DENSE + 4
WIDTH = 8 + 8 * DENSE + 2 * LEVELS * LANES  # bytes
# Bounds of a hash word below which a paragraph belongs to level 1, 2, ...
_BOUNDS = np.array([1 << 64 - 2 * k for k in range(1, LEVELS)], dtype=np.uint64)
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def pieces(line: str) -> list[str]:
    """The line, or, if it is over LONG characters, its pieces: a place is a cut if a hash of the REACH characters before
    it says so, so a change moves no cuts but those near it."""
    if len(line) <= LONG:
        return [line]
    points = np.frombuffer(line.encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    points = points * _MIX
    points ^= points >> np.uint64(29)
    total = np.zeros(len(points) - REACH + 1, dtype=np.uint64)
    for k in range(REACH):
        total = total * _STEP + points[k:k + len(total)]
    total ^= total >> np.uint64(32)
    cuts = (np.flatnonzero(total * _MIX >> np.uint64(59) == 0) + REACH).tolist()
    return [x for a, b in zip([0, *cuts], [*cuts, len(line)]) if (x := line[a:b])]


class Fingerprint:
    """The sum of paragraph vectors."""

    __slots__ = ("wide", "lanes")

    def __init__(self, wide: np.ndarray | None = None, lanes: np.ndarray | None = None) -> None:
        self.wide = np.zeros(1 + DENSE, dtype=np.uint64) if wide is None else wide
        self.lanes = np.zeros((LEVELS, LANES), dtype=np.uint16) if lanes is None else lanes

    @classmethod
    def of(cls, text: str | None) -> Fingerprint:
        parts = [p for line in (text or "").split("\n") if line for p in pieces(line)]
        if not parts:
            return cls()
        digests = b"".join(hashlib.blake2b(p.encode("utf-8", "replace"), digest_size=_DIGEST).digest() for p in parts)
        table = np.frombuffer(digests, dtype=np.uint8).reshape(-1, _DIGEST)
        words = np.ascontiguousarray(table[:, :8 * DENSE]).view("<u8")
        dense = words.sum(axis=0, dtype=np.uint64)
        last = np.ascontiguousarray(table[:, 8 * DENSE:]).view("<u2")
        level = (words[:, :1] < _BOUNDS).sum(axis=1)  # the coarsest that takes the paragraph; finer ones do too
        sums = np.bincount(level * LANES + last[:, 0] % LANES, weights=last[:, 1] | 1, minlength=LEVELS * LANES)
        sums = sums.astype(np.uint64).reshape(LEVELS, LANES)[::-1].cumsum(axis=0, dtype=np.uint64)[::-1]
        return cls(np.concatenate([np.array([len(parts)], dtype=np.uint64), dense]),
                   (sums & np.uint64(0xFFFF)).astype(np.uint16))

    @classmethod
    def read(cls, text: str) -> Fingerprint:
        data = bytes.fromhex(text)
        return cls(np.frombuffer(data, "<u8", 1 + DENSE), np.frombuffer(data, "<u2", LEVELS * LANES, 8 * (1 + DENSE)).reshape(LEVELS, LANES))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide + other.wide, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.wide - other.wide, self.lanes - other.lanes)

    def __bytes__(self) -> bytes:
        return self.wide.astype("<u8").tobytes() + self.lanes.astype("<u2").tobytes()

    def __str__(self) -> str:
        return bytes(self).hex()

    def likeness(self, other: Fingerprint) -> float:
        """Estimated share of common paragraphs among all of both: 1 for equal multisets."""
        if np.array_equal(self.wide, other.wide) and np.array_equal(self.lanes, other.lanes):
            return 1.0
        mine, theirs = int(self.wide[0]), int(other.wide[0])
        equal = (self.lanes == other.lanes).sum(axis=1).tolist()
        level = next((k for k, n in enumerate(equal) if n >= FEW_EQUAL), LEVELS - 1)
        apart = -LANES * math.log(equal[level] / LANES) * 4.0 ** level if equal[level] else float(mine + theirs)
        apart = min(max(apart, abs(mine - theirs), 1.0), mine + theirs)
        return (mine + theirs - apart) / (mine + theirs + apart)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of the following text, or all."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _finished(text: str, own: Fingerprint, following: str, next_: Fingerprint) -> tuple[bytes, bytes, float, float]:
    new = edited(text, following)
    changed = Fingerprint.of(new) if new != text else own
    return (hashlib.sha256(new.encode("utf-8", "replace")).digest(), bytes(changed), own.likeness(changed),
            own.likeness(next_))


# Bytes are written between the steps, which takes half the room of the digits that they are spelled with at the end.
_RESULTS = ("n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, "
            "near_next double")
_NAMES = [x.split()[0] for x in _RESULTS.split(", ")]


def fingerprints(docs: DataFrame, carry: Sequence[str] | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Every input row with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The next document is that of the next larger id; after the last comes the first, so a lone document is its own next
    one. Null ids come first; equal ids are ordered by hashes of their texts. A null text is an empty one, whose
    fingerprint is all zeros. Result columns replace those of the same name; an empty table gives none.
    carry: input columns to return, all by default.

    Texts are dealt to the tasks in ranges of ids, once. Within a range the next text is at hand; the first and
    last text of each range are kept with the results and meet in a join of neighbouring ranges.
    """
    own = F.struct(*[F.col(quoted(c)) for c in carry or docs.columns])
    order = ["id", "h"]
    rows = docs.select(own.alias(ROW), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("h"),
                       F.coalesce(docs[text_col], F.lit("")).alias("t"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, place = TaskContext.get().partitionId(), None, 0

        def made(rows: list[tuple], results: list[tuple]) -> pa.RecordBatch:
            columns = {ROW: pa.concat_arrays([r[0] for r in rows]) if rows else pa.array([], row_type)}
            for k, name in enumerate(_NAMES):
                kind = pa.int64() if name == "n_chars" else pa.float64() if name.startswith("near") else pa.binary()
                columns[name] = pa.array([x[k] for x in results], kind)
            columns["part"] = pa.array([part] * len(rows), pa.int32())
            columns["is_first"] = pa.array([r[3] == 0 for r in rows], pa.bool_())
            columns["is_last"] = pa.array([x[1] is None for x in results], pa.bool_())
            columns["t"] = pa.array([r[1] if r[3] == 0 or x[1] is None else None for r, x in zip(rows, results)], pa.string())
            return pa.RecordBatch.from_pydict(columns)

        row_type = None
        for batch in batches:
            carried, texts = batch.column(ROW), batch.column("t").to_pylist()
            row_type = carried.type
            done, results = [], []
            for i, text in enumerate(texts):
                now = (carried.slice(i, 1), text, Fingerprint.of(text), place)
                place += 1
                if held is not None:
                    new = _finished(held[1], held[2], text, now[2])
                    done.append(held)
                    results.append((len(held[1]), new[0], bytes(held[2]), *new[1:]))
                held = now
            if done:
                yield made(done, results)
        if held is not None:
            yield made([held], [(len(held[1]), None, bytes(held[2]), None, None, None)])

    table = cut(dealt.mapInArrow(walked, with_fields(
        rows, [ROW], f"{_RESULTS}, part int, is_first boolean, is_last boolean, t string")))
    parts = sorted(r.part for r in table.filter("is_first").select("part").collect())  # one number per range
    following = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    firsts = table.filter("is_first").select(F.col("part").alias("next_part"), F.col("t").alias("next_t"))
    lasts = table.filter("is_last").join(following, "part").join(firsts, "next_part")

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = []
            for text, next_text in zip(batch.column("t").to_pylist(), batch.column("next_t").to_pylist()):
                mine = Fingerprint.of(text)
                new = _finished(text, mine, next_text, Fingerprint.of(next_text))
                results.append((len(text), new[0], bytes(mine), *new[1:]))
            yield pa.RecordBatch.from_pydict({ROW: batch.column(ROW), **{
                name: pa.array([x[k] for x in results]) for k, name in enumerate(_NAMES)}})

    ends = lasts.select(ROW, "t", "next_t").mapInArrow(closed, with_fields(lasts, [ROW], _RESULTS))
    every = table.filter("NOT is_last").select(ROW, *_NAMES).unionByName(ends)
    for name in ("edited_sha256", "fingerprint", "edited_fingerprint"):
        every = every.withColumn(name, F.lower(F.hex(name)))
    return unnested(every, *_NAMES)
