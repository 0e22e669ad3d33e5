"""Removing repeated and nearly repeated lines by a segment-partition edit join.

A line goes if the same line, or one at most one edit away, stands earlier in the corpus: in a document of smaller id, or
higher up in its own. Lines shorter than MIN_CHARS always stay.

A threshold of one edit needs two segments: of two lines within one edit, one half of the shorter (or equally long) line
stands unchanged in the other, at the same place counted from the start (first half) or from the end (second half). So a
line is posted under its own two halves and probes, for lines one character shorter, with its own leading and trailing
parts of their halves' lengths: four keys per distinct line, each with length and side in it.

Lines that meet under a key are verified by banded bit-parallel edit distance. A key of more than GROUP lines is not
verified pair by pair: its lines are posted anew under their deletions, where one shared key is a link by itself, so the
work grows with the number of characters, not with the square of the group.

Only keys and hashes are shuffled; texts of candidate lines are fetched once the keys have met.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, all_of, unnested
from rollmatch.session import cut

MIN_CHARS = 16
EDITS = 1
GROUP = 256
BUCKETS = 1 << 18
DOC = ["none", "id", "h1", "h2"]  # a document's place in the corpus: nulls last, then id, then text hashes
LINE = ["l1", "l2"]


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance of two texts is at most `edits`.

    The common start and end are cut off, then a band of 2 * edits + 1 diagonals is followed row by row: bits of
    `up` and `down` are the differences between neighbouring cells of the band's column.
    """
    if abs(len(a) - len(b)) > edits:
        return False
    for _ in range(2):  # the common start, then, both turned round, the common end
        low, high = 0, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
        a, b = a[low:][::-1], b[low:][::-1]
    width, place = (1 << 2 * edits + 1) - 1, {}
    for i, c in enumerate(a):
        place[c] = place.get(c, 0) | 1 << i
    # Bit d of alive[e] after j characters of b: the first j - edits + d characters of a can become them in e edits.
    alive = [((1 << e + 1) - 1) << edits & width for e in range(edits + 1)]
    for j, c in enumerate(b):
        found = place.get(c, 0)
        same = (found >> j - edits if j >= edits else found << edits - j) & width
        last = alive
        alive = [last[0] & same]
        for e in range(1, edits + 1):  # equal, replaced, added, left out
            alive.append((last[e] & same | last[e - 1] | last[e - 1] >> 1 | alive[e - 1] << 1) & width)
        if not alive[edits]:
            return False
    return bool(alive[edits] >> (len(a) - len(b) + edits) & 1)


def _hashes(value: Column, a: str, b: str) -> list[Column]:
    return [F.xxhash64(value).alias(a), F.xxhash64(F.lit(7), value).alias(b)]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each line of MIN_CHARS or more with its document's place, its number and its hashes."""
    rows = docs.select(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), *_hashes(docs[text_col], "h1", "h2"),
                       F.posexplode(F.split(docs[text_col], "\n")).alias("line_no", "line"))
    return rows.filter(F.length("line") >= MIN_CHARS).select("*", *_hashes(F.col("line"), *LINE))


def _keys(line: Column) -> Column:
    """Own halves, then the parts that a half of a line one character shorter would have to equal."""
    n = F.length(line)
    half, less = (n / 2).cast("int"), ((n - 1) / 2).cast("int")
    return F.array(F.xxhash64(n, F.lit(1), F.substring(line, F.lit(1), half)),
                   F.xxhash64(n, F.lit(2), F.substring(line, half + 1, n)),
                   F.xxhash64(n - 1, F.lit(1), F.substring(line, F.lit(1), less)),
                   F.xxhash64(n - 1, F.lit(2), F.substring(line, less + 2, n)))


def _verified(groups: DataFrame) -> DataFrame:
    """Lines with an earlier one within EDITS under the same key. groups: m, the (first, l1, l2, own, line) of a key."""
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            late: set[tuple[int, int]] = set()
            for group in batch.column("m"):
                rows = group.as_py()  # by first occurrence
                for j in range(1, len(rows)):
                    key = rows[j]["l1"], rows[j]["l2"]
                    if key not in late and any(
                            (rows[i]["own"] or rows[j]["own"]) and within(rows[i]["line"], rows[j]["line"], EDITS)
                            for i in range(j)):
                        late.add(key)
            yield pa.RecordBatch.from_pydict({c: pa.array([k[i] for k in late], pa.int64()) for i, c in enumerate(LINE)})

    return groups.mapInArrow(checked, "l1 long, l2 long")


def _linked_by_deletion(hot: DataFrame) -> DataFrame:
    """Lines with an earlier one within one edit, among lines (first, l1, l2, line) of very common keys.

    Equal after the same character is left out: one was replaced. A line equal to another without one character: one
    was added. In either group all is told by the smallest first occurrence.
    """
    def deleted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, key, role = [], [], []
            for i, line in enumerate(batch.column("line").to_pylist()):
                n = len(line)
                forms = [line[:k] + line[k + 1:] for k in range(n)]
                key += [f"{n}:{k}:{f}" for k, f in enumerate(forms)]
                longer = list(dict.fromkeys(forms))
                key += [f"{n - 1}:{f}" for f in longer] + [f"{n}:{line}"]
                role += [0] * n + [1] * len(longer) + [2]
                source += [i] * (n + len(longer) + 1)
                if len(source) > 50_000:
                    yield made(batch, source, key, role)
                    source, key, role = [], [], []
            yield made(batch, source, key, role)

    def made(batch: pa.RecordBatch, source: list[int], key: list[str], role: list[int]) -> pa.RecordBatch:
        digests = np.frombuffer(b"".join(blake2b(k.encode(), digest_size=16).digest() for k in key), dtype=np.int64)
        at = pa.array(source, pa.int64())
        return pa.RecordBatch.from_pydict({
            **{c: batch.column(c).take(at) for c in ("first", *LINE)}, "k1": pa.array(digests[::2]),
            "k2": pa.array(digests[1::2]), "role": pa.array(role, pa.int32())})

    first = hot.schema["first"].dataType.simpleString()
    rows = cut(hot.select("first", *LINE, "line").mapInArrow(
        deleted, f"first {first}, l1 long, l2 long, k1 long, k2 long, role int"))
    least = rows.groupBy("k1", "k2").agg(
        F.count("*").alias("n"), *[F.min(F.when(F.col("role") == r, F.col("first"))).alias(f"m{r}") for r in range(3)])
    met = rows.join(least.filter("n > 1"), ["k1", "k2"])
    late = ((F.col("role") == 0) & (F.col("first") > F.col("m0"))) | ((F.col("role") == 1) & (F.col("first") > F.col("m2"))) \
        | ((F.col("role") == 2) & (F.col("first") > F.col("m1")))
    return met.filter(late).select(*LINE)


def _near_lines(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct lines (l1, l2) with an earlier line within EDITS."""
    posted = known.select(*LINE, F.posexplode("keys").alias("role", "key"))
    shared = posted.groupBy("key").agg(F.count("*").alias("n"), F.min("role").alias("least")).filter("n > 1 AND least < 2")
    hits = cut(posted.join(shared, "key").select("key", *LINE, (F.col("role") < 2).alias("own"), "n"))
    wanted = hits.select(*LINE).distinct().join(known.select(*LINE, "first"), LINE)
    texts = cut(_fetched(docs, cut(wanted), id_col, text_col))
    few = hits.filter(F.col("n") <= GROUP).join(texts, LINE)
    groups = few.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("first", *LINE, "own", "line"))).alias("m"))
    found = [_verified(groups.select("m"))]
    many = hits.filter(F.col("n") > GROUP)
    if many.limit(1).count():
        found.append(_linked_by_deletion(texts.join(many.select(*LINE).distinct(), LINE)))
    return all_of(found).distinct()


def _fetched(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """wanted (l1, l2, first) with the text of the line, from its first occurrence. A fixed number of hash buckets tells
    most other lines apart before texts are shuffled; the join is exact."""
    bucket = F.pmod(F.xxhash64(*LINE), F.lit(BUCKETS)).cast("int")
    hit = wanted.select(bucket.alias("bucket")).distinct()
    near = _lines(docs, id_col, text_col).withColumn("bucket", bucket).join(F.broadcast(hit), "bucket", "left_semi")
    near = near.select("line", *LINE, F.struct(*DOC, "line_no").alias("at"))
    return (near.join(wanted, LINE).filter(F.col("at").eqNullSafe(F.col("first")))
            .select("first", *LINE, "line").dropDuplicates(LINE))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(none, id, h1, h2, dropped): for each document that loses lines, their numbers from 0."""
    lines = cut(_lines(docs, id_col, text_col).select(*DOC, "line_no", *LINE, _keys(F.col("line")).alias("keys")))
    known = cut(lines.groupBy(*LINE).agg(F.count("*").alias("n"), F.min(F.struct(*DOC, "line_no")).alias("first"),
                                         F.first("keys").alias("keys")))
    near = cut(_near_lines(docs, known, id_col, text_col))
    all_gone = near.withColumn("near", F.lit(True))
    special = known.filter("n > 1").select(*LINE, "first").join(all_gone, LINE, "full")
    met = lines.select(*DOC, "line_no", *LINE).join(special, LINE)
    # Of a line with an earlier neighbour no occurrence stays; of another, the first does.
    gone = met.filter(F.coalesce("near", F.lit(False)) | ~F.struct(*DOC, "line_no").eqNullSafe(F.col("first")))
    return gone.groupBy(*DOC).agg(F.collect_set("line_no").alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every input row, its text without the lines that go, with n_lines and n_dropped (long).

    A null text has no lines and stays null; an empty one has one empty line. Rows that repeat an id and its text are
    one document: each keeps the same lines. Null ids come last; documents of one id are ordered by hashes of their
    texts. Result columns replace those of the same name; an empty table gives none.
    """
    gone = cut(repeated_lines(docs, id_col, text_col))
    own = F.struct(*[F.col(quoted(c)) for c in docs.columns])
    rows = docs.select(own.alias(ROW), docs[id_col].alias("did"), docs[text_col].alias("t"),
                       *_hashes(docs[text_col], "d1", "d2"))
    met = rows.join(gone, (F.col("d1") == F.col("h1")) & (F.col("d2") == F.col("h2"))
                    & F.col("did").eqNullSafe(F.col("id")), "left")
    met = met.withColumn("lines", F.split("t", "\n"))
    left = F.expr("array_except(sequence(0, size(lines) - 1), dropped)")
    met = met.withColumn("left", F.when(F.col("dropped").isNotNull(), left))
    text = F.when(F.col("left").isNull(), F.col("t")).otherwise(
        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n"))
    met = met.select(ROW, text.alias(text_col), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                     F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))
    names = docs.columns
    out = unnested(met, text_col, "n_lines", "n_dropped")
    return out.select(*[quoted(c) for c in names if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
