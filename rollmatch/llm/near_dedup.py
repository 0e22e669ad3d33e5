"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

A document is its set of five-word shingles; two documents are linked where 100 * intersection >= 75 * union. Groups are
the connected components of the links.

1. Equal sets are one class; from here on only classes are handled. A class has COORDINATES minimum hashes.
2. A class is posted under each coordinate-value pair. Values that one class alone has cannot collide and are dropped.
   Two classes are candidates if at least MATCHES coordinates collide; a pair with similarity 0.75 misses that with
   probability below 1e-6. Prefix: ordered from the rarest pair on, candidates must meet within all but the last
   MATCHES - 1 of their pairs, so only those are merged and the long postings of shared passages are skipped.
3. A posting of up to POSTING classes is walked in one task: classes not reached yet are counted against the reached
   one, so a posting of like classes costs about its length. A longer posting ties all to its smallest class uncounted:
   that can only widen the groups in which links are sought.
4. Candidate groups are confirmed on full shingle sets. A group of up to BLOCK classes is one task's work, many groups
   to a task. In a larger one every class is first compared with the group's most typical class; only classes not linked to
   it are compared with all others, block by block, each task returning a spanning forest of the links it finds.

No step returns all pairs of a group, and no link between different sets is lost but by the stated probability.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, all_of, unnested, with_fields
from rollmatch.llm.components import components
from rollmatch.llm.shingles import mixed, sets
from rollmatch.session import cut

COORDINATES = 48
MATCHES = 20
POSTING = 2048
BLOCK = 256
SIMILAR_PERCENT = 75
BUCKETS = 1 << 18        # of the filter that spares most texts the second shuffle
TASK_BYTES = 16 << 20    # of shingle sets dealt to one task
_SALTS = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Coordinate-value pairs as one number each: 32 bits of the minimum hash, then the coordinate's number."""
    out = np.empty(COORDINATES, dtype=np.int64)
    for k, salt in enumerate(_SALTS):
        least = ((shingles ^ salt) * (salt | np.uint64(1))).min()
        out[k] = (int(least) >> 32) << 6 | k
    return out


def _sketch(docs: DataFrame, carry: Sequence[str], id_col: str, text_col: str) -> DataFrame:
    """Carried columns under ROW, id, h1, h2 (hashes of the text), n_shingles, digest (of the set, null if it is empty)
    and pairs (the signature)."""
    own = F.struct(*[F.col(quoted(c)) for c in carry])
    rows = docs.select(own.alias(ROW), docs[id_col].alias("id"), *_text_hashes(docs[text_col]), docs[text_col].alias("t"))

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part, n, digest, pairs = batch.slice(at, 1000), [], [], []
                for found in sets(part.column("t").to_pylist()):
                    n.append(len(found))
                    digest.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                    pairs.append(signature(found) if len(found) else None)
                yield pa.RecordBatch.from_pydict({
                    **{c: part.column(c) for c in part.schema.names if c != "t"}, "n_shingles": pa.array(n, pa.int64()),
                    "digest": pa.array(digest, pa.binary()), "pairs": pa.array(pairs, pa.list_(pa.int64()))})

    return rows.mapInArrow(sketched, with_fields(rows, rows.columns[:-1], "n_shingles long, digest binary, pairs array<bigint>"))


def _text_hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def _candidate_edges(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) that span the candidate groups, and how typical each class is (cid, weight)."""
    postings = classes.select("cid", F.explode("pairs").alias("pair"))
    shared = postings.groupBy("pair").agg(F.count("*").alias("n")).filter("n > 1")
    kept = (postings.join(shared, "pair").groupBy("cid")
            .agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("own"), F.sum("n").alias("weight"))
            .filter(F.size("own") >= MATCHES))
    kept = cut(kept.join(classes.select("cid", "pairs"), "cid"))
    prefix = F.slice("own", F.lit(1), F.size("own") - (MATCHES - 1))
    merged = cut(kept.select("cid", "pairs", F.explode(F.transform(prefix, lambda x: x["pair"])).alias("pair")))
    sizes = merged.groupBy("pair").agg(F.count("*").alias("n"), F.min("cid").alias("least")).filter("n > 1")
    merged = merged.join(sizes, "pair")
    wide = merged.filter(F.col("n") > POSTING).filter("cid <> least").select(F.col("least").alias("a"), F.col("cid").alias("b"))
    lists = (merged.filter(F.col("n") <= POSTING).groupBy("pair")
             .agg(F.array_sort(F.collect_list(F.struct("cid", "pairs"))).alias("m")).select("m"))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("m")
            at = column.offsets.to_numpy()
            inner = column.values
            cids = inner.field("cid").to_pylist()
            table = inner.field("pairs").values.to_numpy().reshape(-1, COORDINATES)
            seen: set[tuple[int, int]] = set()
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                for x, y in spanning(b - a, lambda i, open_, t=table[a:b]: (t[open_] == t[i]).sum(axis=1) >= MATCHES):
                    seen.add((cids[a + x], cids[a + y]))
            yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in seen], pa.int64()),
                                              "b": pa.array([y for _, y in seen], pa.int64())})

    return wide.unionByName(lists.mapInArrow(walked, "a long, b long")), kept.select("cid", "weight")


def spanning(n: int, linked) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest over 0 to n - 1; linked(i, others) tells which of the others i is linked to."""
    open_ = np.arange(n)
    while len(open_) > 1:
        frontier, open_ = [int(open_[0])], open_[1:]
        while frontier and len(open_):
            i = frontier.pop()
            hit = linked(i, open_)
            found = open_[hit]
            open_ = open_[~hit]
            for j in found.tolist():
                yield i, j
            frontier.extend(found.tolist())


class Overlaps:
    """Which of many shingle sets are similar enough to one of them."""

    def __init__(self, packed: Sequence[bytes]) -> None:
        parts = [np.frombuffer(p, dtype=np.uint64) for p in packed]
        self.sizes = np.array([len(p) for p in parts])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        _, self.ids = np.unique(np.concatenate(parts), return_inverse=True)
        self.marks = np.zeros(self.ids.max() + 1, dtype=np.int64)

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.ids[self.starts[i]:self.starts[i + 1]]
        fits = np.minimum(self.sizes[others], len(own)) * 100 >= SIMILAR_PERCENT * np.maximum(self.sizes[others], len(own))
        out = np.zeros(len(others), dtype=bool)
        if fits.any():
            self.marks[own] = 1
            for k in np.flatnonzero(fits):
                both = int(self.marks[self.ids[self.starts[others[k]]:self.starts[others[k] + 1]]].sum())
                out[k] = 100 * both >= SIMILAR_PERCENT * (len(own) + self.sizes[others[k]] - both)
            self.marks[own] = 0
        return out


def _fetched_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """wanted (id, h1, h2 of one document per class, and more) with `shingles`, the packed set of that document.

    A fixed number of hash buckets tells most other documents apart before their texts are shuffled; the join is exact.
    """
    rows = docs.select(docs[id_col].alias("did"), *[h.alias(f"d{k}") for k, h in enumerate(_text_hashes(docs[text_col]))],
                       docs[text_col].alias("t"))
    bucket = F.pmod(F.xxhash64("did", "d0"), F.lit(BUCKETS)).cast("int")
    hit = wanted.select(F.pmod(F.xxhash64("id", "h1"), F.lit(BUCKETS)).cast("int").alias("bucket")).distinct()
    near = rows.withColumn("bucket", bucket).join(F.broadcast(hit), "bucket", "left_semi").drop("bucket")
    found = near.join(wanted, (F.col("d0") == F.col("h1")) & (F.col("d1") == F.col("h2"))
                      & F.col("did").eqNullSafe(F.col("id"))).drop("did", "d0", "d1", "id", "h1", "h2")
    found = found.dropDuplicates(["cid"])
    names = [c for c in found.columns if c != "t"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_pydict({
                    **{c: part.column(c) for c in names},
                    "shingles": pa.array([s.tobytes() for s in sets(part.column("t").to_pylist())], pa.binary())})

    return cut(found.mapInArrow(packed, with_fields(found, names, "shingles binary")))


def _confirm_small(group: pd.DataFrame) -> pd.DataFrame:
    """Links within each of many small candidate groups, as spanning forests."""
    edges = []
    for _, one in group.groupby("root", sort=False):
        one = one.sort_values("cid")
        cids, overlaps = one["cid"].tolist(), Overlaps(one["shingles"].tolist())
        edges += [(cids[i], cids[j]) for i, j in spanning(len(cids), overlaps.linked)]
    return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")


def _confirm_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Links between classes of two blocks, or within one, of a large candidate group, as a spanning forest."""
    group = group.sort_values("cid")
    cids, overlaps = group["cid"].tolist(), Overlaps(group["shingles"].tolist())
    return pd.DataFrame([(cids[i], cids[j]) for i, j in spanning(len(cids), overlaps.linked)], columns=["a", "b"], dtype="int64")


def _linked_to_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = []
        for own, leader in zip(batch.column("shingles").to_pylist(), batch.column("typical").to_pylist()):
            linked.append(bool(Overlaps([own, leader]).linked(0, np.array([1]))[0]))
        yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("root", "cid", "leader")},
                                          "linked": pa.array(linked, pa.bool_())})


def _confirm_large(large: DataFrame) -> DataFrame:
    """Links (a, b) that span the true groups inside candidate groups of more than BLOCK classes."""
    typical = large.groupBy("root").agg(F.max(F.struct("weight", "cid"))["cid"].alias("leader"))
    leaders = typical.join(large.select(F.col("cid").alias("leader"), F.col("shingles").alias("typical")), "leader")
    told = cut(large.select("root", "cid", "shingles").join(leaders, "root").select("root", "cid", "leader", "shingles", "typical")
               .mapInArrow(_linked_to_leader, "root long, cid long, leader long, linked boolean"))
    to_leader = told.filter("linked AND cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b"))
    counts = told.groupBy("root").agg(F.sum((~F.col("linked")).cast("long")).alias("others"), F.count("*").alias("n"))
    counts = counts.filter("others > 0").withColumn("blocks", F.expr(f"n div {BLOCK} + 1")).withColumn(
        "mine", F.expr(f"others div {BLOCK} + 1"))
    rows = (told.select("root", "cid", "linked").join(counts, "root").join(large.select("cid", "shingles"), "cid"))
    h = F.xxhash64("cid")
    rows = (rows.withColumn("i", F.when(~F.col("linked"), F.pmod(h, "mine"))).withColumn("j", F.pmod(h, "blocks")))
    # An unlinked class meets each block of linked ones (at j) and each block of unlinked ones (at i).
    met = F.when(F.col("linked"), F.transform(F.sequence(F.lit(0), F.col("mine") - 1), lambda k: F.struct(
        k.cast("long").alias("x"), (F.col("j") + F.col("mine")).cast("long").alias("y")))).otherwise(F.concat(
            F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(
                F.col("i").cast("long").alias("x"), (k + F.col("mine")).cast("long").alias("y"))),
            F.transform(F.sequence(F.lit(0), F.col("mine") - 1), lambda k: F.struct(
                F.least("i", k).cast("long").alias("x"), F.greatest("i", k).cast("long").alias("y")))))
    dealt = rows.select("root", "cid", "shingles", F.explode(met).alias("at")).select("root", "cid", "shingles", "at.*")
    across = dealt.groupBy("root", "x", "y").applyInPandas(_confirm_blocks, "a long, b long")
    return to_leader.unionByName(across)


def near_groups(docs: DataFrame, carry: Sequence[str] | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every input row with n_shingles (long), component_id (the smallest id in its group) and first (boolean: it is the
    group's first row by id, then text hash).

    A null or wordless text has no shingles and is a group of its own: component_id is its id. A text of fewer than
    five words is one shingle. Null ids come last. Repeated rows are in one group and may all be first. Result
    columns replace those of the same name; an empty table gives none. carry: input columns to return, all by default.
    """
    sketch = cut(_sketch(docs, carry or docs.columns, id_col, text_col))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2")
    # A class gets a number as its row is written, which the written table then keeps.
    classes = cut(sketch.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(order).alias("least"), F.first("pairs").alias("pairs"), F.first("n_shingles").alias("n"))
        .withColumn("cid", F.monotonically_increasing_id()))
    edges, weights = _candidate_edges(classes)
    candidates = components(edges)
    sizes = candidates.groupBy("root").agg(F.count("*").alias("m"))
    wanted = (candidates.withColumnRenamed("node", "cid").join(sizes, "root").join(weights, "cid")
              .join(classes.select("cid", "least", "n"), "cid")
              .select("cid", "root", "m", "weight", "n", "least.id", "least.h1", "least.h2"))
    full = _fetched_sets(docs, cut(wanted), id_col, text_col)
    small = full.filter(F.col("m") <= BLOCK)
    total, most = full.agg(F.sum("n"), F.max("m")).first()
    tasks = int(total or 0) * 8 // TASK_BYTES + 1
    links = small.groupBy(F.pmod(F.xxhash64("root"), F.lit(tasks)).alias("task")).applyInPandas(
        _confirm_small, "a long, b long")
    if (most or 0) > BLOCK:
        links = links.unionByName(_confirm_large(full.filter(F.col("m") > BLOCK)))
    groups = components(links)
    roots = classes.join(groups.withColumnRenamed("node", "cid"), "cid", "left").select(
        "digest", F.coalesce("root", "cid").alias("root"), "least")
    leasts = roots.groupBy("root").agg(F.min("least").alias("group_least"))
    of_class = cut(roots.join(leasts, "root").select("digest", "group_least"))
    has = sketch.filter("digest IS NOT NULL").join(of_class, "digest")
    none = sketch.filter("digest IS NULL").withColumn("group_least", order)
    both = all_of([has.select(*none.columns), none])
    both = both.withColumn("component_id", F.col("group_least.id")).withColumn(
        "first", order.eqNullSafe(F.col("group_least")) | F.col("digest").isNull())
    return unnested(both, "n_shingles", "component_id", "first")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with the input's columns only; rows without shingles all stay."""
    plain = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    hashed = plain.select("id", "text", *_text_hashes(F.col("text")))
    found = near_groups(hashed, ["id", "h1", "h2"], "id", "text").filter("first")
    kept = cut(found.groupBy("id", "h1", "h2").agg(F.count("*").alias("copies"), F.max("n_shingles").alias("n")))
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(ROW), docs[id_col].alias("did"),
                       *[h.alias(f"d{k}") for k, h in enumerate(_text_hashes(docs[text_col]))])
    met = rows.join(kept, F.col("did").eqNullSafe(F.col("id")) & (F.col("d0") == F.col("h1")) & (F.col("d1") == F.col("h2")))
    alone = met.filter("copies = 1 OR n = 0").select(ROW)
    again = met.filter("copies > 1 AND n > 0").dropDuplicates(["did", "d0", "d1"]).select(ROW)
    return alone.unionByName(again).select(f"{ROW}.*")
