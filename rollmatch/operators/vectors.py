"""Embeddings and exact nearest-neighbour retrieval.

No pair is ever a row: tasks multiply blocks of vectors and emit at most k items per query and block. A corpus of checked
size is sent to the tasks once. A larger one is dealt into cells around pivots, and a query goes to its own cell first;
then only to those cells that, by the triangle inequality, can hold an item as good as its k-th best so far. Neighbouring
cells share a task, to which a query is sent once, however many of them it visits. Pairs are told apart by products of
half precision with a bound of their error; only those that can be among the best are scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmatch.functions.columns import col, cols
from rollmatch.session import cut, spread_small

# Largest corpus, in bytes of doubles, that is sent to every task; the most bytes of items that a cell is meant to hold, and
# that a task holds of several cells.
CORPUS_BOUND = 32 * 1024 * 1024
BLOCK_BYTES = 128 * 1024 * 1024
HELD_BYTES = 32 * 1024 * 1024
# Cells, and visits that one task answers: items with more visits are copied to as many tasks as that takes.
MOST_PIVOTS = 1024
VISITS = 1_000_000
PAIRS, MOST_TASKS = 200_000_000, 2000
# What rounding can do to a distance, and to a score.
SLACK, NEAR = 1e-6, 1e-8
# Size of the texts whose words one task counts, as the table's files have it.
PART_BYTES = 16 * 1024 * 1024
# Numbers in one slice of a score matrix.
SLICE = 4_000_000
# Decimals that count when scores are compared, so that summation order cannot swap equal scores.
COMPARED = 9


def _matrix(vectors: pd.Series, unit: bool) -> np.ndarray:
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    if not unit or not len(rows):
        return rows
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _exact(queries: np.ndarray, items: np.ndarray, q: np.ndarray, i: np.ndarray, metric: str) -> np.ndarray:
    """Scores of the given pairs of rows."""
    scores = np.empty(len(q))
    step = max(1, SLICE // max(1, queries.shape[1]))
    for low in range(0, len(q), step):
        a, b = queries[q[low:low + step]], items[i[low:low + step]]
        if metric == "cosine":
            scores[low:low + step] = np.einsum("ij,ij->i", a, b)
        else:
            # Summed differences, not the expanded square, which loses digits for near vectors.
            squared = np.zeros(len(a))
            for d in range(a.shape[1]):
                squared += np.square(a[:, d] - b[:, d])
            scores[low:low + step] = -np.sqrt(squared)
    return scores


def _single(rows: np.ndarray, metric: str, items: bool) -> np.ndarray:
    """Vectors in single precision whose products order the items of a query; for distances with a place more, so that a
    product is q*i - i*i/2."""
    if metric == "l2":
        rows = np.column_stack([rows, (rows * rows).sum(1) / -2 if items else np.ones(len(rows))])
    return rows.astype(np.float32)


class _Best:
    """The k best items of each query of a batch so far; equal scores go to the smaller item number."""

    def __init__(self, queries: np.ndarray, k: int, metric: str, known: np.ndarray | None = None) -> None:
        self.queries, self.k, self.metric = queries, k, metric
        self.single = _single(queries, metric, False)
        self.norms = np.sqrt((queries * queries).sum(1))
        # What a score has to reach, as far as is known.
        self.floor = np.full(len(queries), -np.inf) if known is None else np.where(np.isnan(known), -np.inf, known)
        self.q, self.i, self.s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, items: np.ndarray, single: np.ndarray, places: np.ndarray | None = None,
            asked: np.ndarray | None = None) -> None:
        """Compare the asked queries (all) with the items at the given places (all)."""
        asked = np.arange(len(self.queries)) if asked is None else asked
        width = max(1, min(SLICE // max(1, len(asked)), len(items)), min(self.k, len(items)), min(1024, len(items)))
        step = max(1, SLICE // width)
        total = len(items) if places is None else len(places)
        for first in range(0, total, width):
            at = slice(first, min(first + width, total)) if places is None else places[first:first + width]
            block, exact = single[at], items[at]
            number = np.arange(first, first + len(block)) if places is None else at
            longest = np.sqrt((exact * exact).sum(1).max()) if len(exact) else 0.0
            for low in range(0, len(asked), step):
                self._slice(asked[low:low + step], exact, block, number, longest)

    def _slice(self, asked: np.ndarray, items: np.ndarray, single: np.ndarray, number: np.ndarray, longest: float) -> None:
        with np.errstate(invalid="ignore", over="ignore"):
            product = self.single[asked] @ single.T
            norms, floor = self.norms[asked], self.floor[asked]
            # The error of a product in single precision.
            slack = (self.queries.shape[1] + 8) * np.finfo(np.float32).eps * longest * (
                norms + (longest if self.metric == "l2" else 0)) + NEAR
            if self.metric == "l2":
                least = (norms * norms - np.square(NEAR - floor)) / 2 - slack - 1e-12 * (norms * norms + np.square(floor))
            else:
                least = floor - NEAR - slack
            unknown = np.flatnonzero(floor == -np.inf)
            least[unknown] = -np.inf
            if len(unknown) and product.shape[1] > self.k:
                kth = np.partition(product[unknown], -self.k, axis=1)[:, -self.k]
                # The k-th best is compared in as many decimals as the floor is.
                near = NEAR if self.metric == "cosine" else 2 * NEAR * (norms[unknown] + longest)
                least[unknown] = kth - 2 * slack[unknown] - near
            # In single precision as the products, rounded down; what is not a number is looked at.
            bound = np.nextafter(least.astype(np.float32), np.float32(-np.inf))
            q, i = np.nonzero(~(product < bound[:, None]))
        if not len(q):
            return
        found = _exact(self.queries[asked], items, q, i, self.metric)
        touched = np.zeros(len(self.queries), dtype=bool)
        touched[asked[q]] = True
        held = touched[self.q]
        q, i, s = (np.concatenate(x) for x in (
            (self.q[held], asked[q]), (self.i[held], number[i]), (self.s[held], found)))
        ranked = np.lexsort((i, -np.round(s, COMPARED), q))
        q, i, s = q[ranked], i[ranked], s[ranked]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        last = rank == self.k - 1
        self.floor[q[last]] = np.fmax(self.floor[q[last]], np.round(s[last], COMPARED))
        top = rank < self.k
        self.q, self.i, self.s = (np.concatenate(x) for x in (
            (self.q[~held], q[top]), (self.i[~held], i[top]), (self.s[~held], s[top])))

    def rows(self) -> tuple[np.ndarray, ...]:
        """(query row, item number, score, rank)."""
        order = np.lexsort((self.i, -np.round(self.s, COMPARED), self.q))
        q, i, s = self.q[order], self.i[order], self.s[order]
        return q, i, s, np.arange(len(q)) - np.searchsorted(q, q) + 1


def nearest(queries: DataFrame, items: DataFrame, k: int, query_id: str, query_vector: str, item_id: str,
            item_vector: str, metric: str = "cosine", bound: int = CORPUS_BOUND,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k nearest items per query: (query id, rank from 1, item id, score), score descending, then item id.

    `metric` is `cosine` (score = similarity) or `l2` (score = negative distance). Queries without a vector
    have no rows.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    asked = queries.select(col(query_id).alias("q"), col(query_vector).alias("v")).where(F.col("v").isNotNull())
    held = items.select(col(item_id).alias("i"), col(item_vector).alias("v")).where(F.col("v").isNotNull())
    # An upper bound of the corpus size from its row count and the width of one vector.
    n_items, one = items.count(), held.select(F.size("v").alias("width")).first()
    vector_bytes = 8 * max(1, one["width"] if one else 1)
    schema = T.StructType([
        T.StructField("q", asked.schema["q"].dataType), T.StructField("i", held.schema["i"].dataType),
        T.StructField("s", T.DoubleType()), T.StructField("rank", T.IntegerType())])
    if n_items * vector_bytes <= bound:
        ranked = _against_all(spread_small(asked, "q"), held, k, metric, schema)
    else:
        found = _by_pivots(asked, held, k, metric, schema, max(1, block_bytes // vector_bytes), n_items)
        by_score = Window.partitionBy("q").orderBy(F.round("s", COMPARED).desc(), F.asc("i"))
        ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select(F.col("q").alias(query_id), "rank", F.col("i").alias(f"near_{item_id}"),
                         F.col("s").alias("score"))


def _against_all(asked: DataFrame, held: DataFrame, k: int, metric: str, schema: T.StructType) -> DataFrame:
    corpus = held.toPandas().sort_values("i", kind="stable")
    ids = corpus["i"].to_numpy()
    unit = metric == "cosine"
    shared = asked.sparkSession.sparkContext.broadcast((ids, _matrix(corpus["v"], unit)))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item_ids, matrix = shared.value
        single = _single(matrix, metric, True) if len(item_ids) else None
        for batch in batches:
            if len(batch) and len(item_ids):
                best = _Best(_matrix(batch["v"], unit), k, metric)
                best.add(matrix, single)
                q, i, s, rank = best.rows()
                yield pd.DataFrame({"q": batch["q"].to_numpy()[q], "i": item_ids[i], "s": s, "rank": rank})

    return asked.mapInPandas(score, schema)


def _vectors(column: pa.ChunkedArray | pa.Array, unit: bool) -> np.ndarray:
    """Vectors of one width as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    if not unit:
        return rows
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squared = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * rows @ pivots.T
    return np.sqrt(np.maximum(squared, 0))


def _home(distance: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """Per query, whether a cell is one of the nearest ones that hold k items between them."""
    nearest_first = np.argsort(distance, axis=1, kind="stable")
    earlier = np.cumsum(count[nearest_first], axis=1) - count[nearest_first]
    home = np.zeros(distance.shape, dtype=bool)
    np.put_along_axis(home, nearest_first, earlier < k, axis=1)
    return home & (count > 0)


def _by_pivots(asked: DataFrame, held: DataFrame, k: int, metric: str, schema: T.StructType, per_block: int,
               n_items: int) -> DataFrame:
    """The k best items of every cell that a query visits; the k best of all are among them.

    An item at distance r of its pivot p is at least |d(q, p) - r| away from q, so a cell whose items lie between `near` and
    `far` of its pivot is left out when even that distance gives a score below the query's k-th best one.
    """
    spark, unit = held.sparkSession, metric == "cosine"
    n_pivots = max(1, min(MOST_PIVOTS, math.ceil(n_items / per_block)))
    asked, held = cut(asked), cut(held)
    # At most MOST_PIVOTS vectors come to the driver, drawn by a hash of their ids.
    drawn = held.orderBy(F.xxhash64("i"), "i").limit(n_pivots).toPandas()
    if not len(drawn):
        return spark.createDataFrame([], schema)
    pivots = spark.sparkContext.broadcast(_matrix(drawn["v"], unit))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                distance = _distances(_vectors(batch.column("v"), unit), pivots.value)
                cell = distance.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance[np.arange(len(cell)), cell])],
                    names=[*batch.schema.names, "cell", "r"])

    items = cut(held.mapInArrow(place, T.StructType(held.schema.fields + _fields("cell int, r double"))))
    stats = items.groupBy("cell").agg(F.count("*").alias("n"), F.min("r").alias("near"), F.max("r").alias("far")).collect()
    count, near, far = np.zeros(len(drawn), np.int64), np.zeros(len(drawn)), np.zeros(len(drawn))
    for row in stats:
        count[row["cell"]], near[row["cell"]], far[row["cell"]] = row["n"], row["near"], row["far"]

    held_most = max(1, HELD_BYTES // (8 * max(1, pivots.value.shape[1])))
    groups, parts = _grouped(count, pivots.value, held_most)

    def cells(rows: np.ndarray, known: np.ndarray | None) -> np.ndarray:
        """Which cells each query visits: the home cells at first, then others that can hold a better item."""
        distance = _distances(rows, pivots.value)
        go = _home(distance, count, k)
        if known is None:
            return go
        least = np.maximum(np.maximum(distance - far, near - distance) - SLACK, 0)
        most = ((rows * rows).sum(1)[:, None] + 1 - least * least) / 2 if unit else -least
        return ~go & (count > 0) & ~(most < known[:, None] - NEAR)  # nothing is below an unknown one

    def visits(queries: DataFrame, first: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                go = cells(_vectors(batch.column("v"), unit), None if first else _known(batch))
                for group in range(len(parts)):
                    chosen = np.flatnonzero(go[:, groups == group].any(1))
                    if len(chosen):
                        yield pa.RecordBatch.from_arrays(
                            [*(batch.column(c).take(pa.array(chosen)) for c in ("q", "v", "kth")),
                             pa.array(np.full(len(chosen), group, np.int32))], names=["q", "v", "kth", "part_of"])

        shape = [queries.schema["q"], queries.schema["v"], *_fields("kth double, part_of int")]
        return cut(queries.mapInArrow(run, T.StructType(shape)))

    placed = items.withColumn("part_of", F.element_at(F.array(*[F.lit(g) for g in groups.tolist()]), F.col("cell") + 1))

    def meet(queries: DataFrame, first: bool) -> DataFrame:
        # Items of a group that a visit is compared with: at first those of its home cells.
        each = [int((count[groups == g].max() if first else count[groups == g].sum())) for g in range(len(parts))]
        return _meet(visits(queries, first), placed, parts, k, metric, schema,
                     lambda batch, rows: cells(rows, None if first else _known(batch)), each)

    one = cut(meet(asked.withColumn("kth", F.lit(None).cast("double")), True))
    kth = one.groupBy("q").agg(F.sort_array(F.collect_list(F.col("s")), asc=False).alias("all")).select(
        F.col("q").alias("asked"), F.get("all", F.lit(k - 1)).alias("kth"))
    again = asked.join(kth, F.col("q").eqNullSafe(F.col("asked")), "left").select("q", "v", "kth")
    return one.unionByName(meet(again, False))


def _known(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("kth").to_numpy(zero_copy_only=False).astype(np.float64)


def _grouped(count: np.ndarray, pivots: np.ndarray, most: int) -> tuple[np.ndarray, list[int]]:
    """Per cell the group it is in, and per group the number of parts its items are dealt into. Cells follow each other by
    the nearest pivot not yet taken; a group is closed when it would hold more than `most` items."""
    group, parts, held = np.zeros(len(count), dtype=np.int64), [], 0
    left, now = np.ones(len(count), dtype=bool), 0
    for _ in range(len(count)):
        left[now] = False
        if not parts or held + count[now] > most:
            parts.append(1)
            held = 0
        group[now] = len(parts) - 1
        held += count[now]
        parts[-1] = max(1, math.ceil(held / most))
        if left.any():
            away = np.where(left, np.square(pivots - pivots[now]).sum(1), np.inf)
            now = int(np.argmin(away)) if np.isfinite(away).any() else int(np.argmax(left))
    return group, parts


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def _meet(visits: DataFrame, items: DataFrame, parts: list[int], k: int, metric: str, schema: T.StructType,
          cells: Callable[[pa.RecordBatch, np.ndarray], np.ndarray], each: list[int]) -> DataFrame:
    """Every visit meets all parts of its group of cells. A part's items stand in front of its visits, so that a task holds
    one part and reads its visits batch by batch; `cells` says which cells of the group a query is compared with."""
    unit = metric == "cosine"
    asked = {r["part_of"]: r["n"] for r in visits.groupBy("part_of").agg(F.count("*").alias("n")).collect()}
    # Copies for the visits there are, and for the pairs there are as far as cores can use them.
    wanted = math.ceil(4 * items.sparkSession.sparkContext.defaultParallelism / max(1, sum(parts)))
    copies = [max(math.ceil(n / VISITS), min(wanted, math.ceil(n * most / PAIRS)))
              for n, most in ((asked.get(g, 0), each[g]) for g in range(len(parts)))]
    tasks = max(1, sum(n * c for n, c in zip(parts, copies)))

    def by_group(numbers: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(n) for n in numbers]), F.col("part_of") + 1)

    no_q, no_i = (F.lit(None).cast(schema[c].dataType).alias(c) for c in ("q", "i"))
    vector = F.col("v").cast("array<double>").alias("v")
    left = items.where(by_group(copies) > 0).select(
        "part_of", F.pmod(F.xxhash64("i"), by_group(parts)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), by_group(copies) - 1)).alias("copy"), F.lit(0).alias("kind"), "cell", no_q, "i", vector,
        F.lit(None).cast("double").alias("kth"))
    right = visits.select(
        "part_of", F.explode(F.sequence(F.lit(0), by_group(parts) - 1)).alias("part"),
        F.pmod(F.xxhash64("q"), by_group(copies)).cast("int").alias("copy"), F.lit(1).alias("kind"), F.lit(0).alias("cell"), "q",
        no_i, vector, "kth")
    place = ["part_of", "part", "copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, rows, homes, ready = None, [], [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (*place, "kind")])
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(0)]))
            for low, high in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                part = batch.slice(low, high - low)
                if tuple(keys[:3, low]) != now:
                    now, ids, rows, homes, ready = tuple(keys[:3, low]), [], [], [], None
                if keys[3, low] == 0:
                    ids.append(part.column("i"))
                    rows.append(_vectors(part.column("v"), unit))
                    homes.append(part.column("cell").to_numpy())
                elif ids:
                    if ready is None:
                        known = pa.concat_arrays(ids)
                        order = pc.sort_indices(known)
                        at = order.to_numpy()
                        matrix, cell = np.concatenate(rows)[at], np.concatenate(homes)[at]
                        ready = known.take(order), matrix, _single(matrix, metric, True), {
                            c: np.flatnonzero(cell == c) for c in np.unique(cell).tolist()}
                        rows = homes = []
                    asked_rows = _vectors(part.column("v"), unit)
                    best = _Best(asked_rows, k, metric, _known(part))
                    go = cells(part, asked_rows)
                    # Cells that the same queries of the batch visit are compared at once.
                    same: dict[bytes, list[int]] = {}
                    for c in ready[3]:
                        same.setdefault(np.packbits(go[:, c]).tobytes(), []).append(c)
                    for together in same.values():
                        who = np.flatnonzero(go[:, together[0]])
                        if len(who):
                            best.add(ready[1], ready[2], np.sort(np.concatenate([ready[3][c] for c in together])), who)
                    q, i, s, rank = best.rows()
                    yield pa.RecordBatch.from_arrays(
                        [part.column("q").take(pa.array(q)), ready[0].take(pa.array(i)), pa.array(s), pa.array(rank.astype(np.int32))],
                        names=["q", "i", "s", "rank"])

    both = left.unionByName(right).repartition(min(4 * tasks, MOST_TASKS), *place)
    return both.sortWithinPartitions(*place, "kind").mapInArrow(run, schema)


def retrieve_jobs(queries: DataFrame, nodes: DataFrame, k: int, key: str, vector: str, node_id: str,
                  metadata: dict[str, str], searchable: Column | None = None, default: dict[str, object] | None = None,
                  **options) -> DataFrame:
    """Ranked retrieval with metadata: (key, rank, <metadata columns>, score).

    `metadata` maps output columns to node columns. Queries that are not `searchable`, or find nothing, get k rows
    of `default` (one value per output column) with score 0 when a default is given. Every query row is answered: of
    several rows with one key, each by its own vector. The nodes may be the result of joins; they are computed once.
    """
    row, able = "__row", F.lit(True) if searchable is None else searchable
    asked = cut(queries.select(col(key), col(vector), able.alias("__able"), F.monotonically_increasing_id().alias(row)))
    nodes = cut(nodes.select(*cols(dict.fromkeys([node_id, vector, *metadata.values()]))))
    hits = nearest(asked.where("__able"), nodes, k, row, vector, node_id, vector, **options)
    described = hits.join(
        nodes.select(col(node_id).alias(f"near_{node_id}"), *[col(c).alias(o) for o, c in metadata.items()]),
        f"near_{node_id}")
    found = described.select(row, "rank", *cols(metadata), "score")
    keys = asked.select(row, col(key))
    if default is None:
        return found.join(keys, row).select(col(key), "rank", *cols(metadata), "score")
    shape = F.struct("rank", *cols(metadata), "score")
    blank = F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.struct(
        i.alias("rank"), *[F.lit(default[o]).cast(found.schema[o].dataType).alias(o) for o in metadata],
        F.lit(0.0).alias("score")))
    filled = keys.join(found, row, "left").select(
        col(key), F.explode(F.when(F.col("rank").isNull(), blank).otherwise(F.array(shape))).alias("r"))
    return filled.select(col(key), "r.*")


def _counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(part, key, term, tf). The texts of a key move to one of as many parts as their size asks for; the words of a part are
    counted where they are."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n = max(docs.sparkSession.sparkContext.defaultParallelism, min(MOST_TASKS, math.ceil(size / PART_BYTES)))
    moved = docs.select(col(key), col(text), F.pmod(F.xxhash64(col(key)), F.lit(n)).alias("__part")).repartition(n, "__part")
    words = moved.select("__part", col(key), F.explode(F.split(F.lower(col(text)), r"\s+")).alias("term")).where(F.col("term") != "")
    return words.groupBy("__part", col(key), "term").agg(F.count(F.lit(1)).alias("tf"))


def term_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): how often each lower-case word stands in a text."""
    return _counts(docs, key, text).drop("__part")


def fit_terms(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, idf): ln((documents + 1) / (documents with the term + 1)), from the corpus that is searched."""
    spread = term_counts(docs, key, text).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    return spread.select("term", F.ln((total + 1) / (F.col("df") + 1)).alias("idf"))


def weigh_terms(docs: DataFrame, key: str, text: str, fitted: DataFrame) -> DataFrame:
    """(key, term, weight) of other texts in the weights of a fitted corpus; a term it does not have has none."""
    return term_counts(docs, key, text).join(fitted, "term").select(
        col(key), "term", (F.col("tf") * F.col("idf")).alias("weight"))


def term_weights(docs: DataFrame, key: str, text: str) -> DataFrame:
    """TF-IDF rows (key, term, weight): term count times ln((documents + 1) / (documents with the term + 1))."""
    # A term meets its count as one row per part, with the keys that hold it, not as a row per key.
    lists = _counts(docs, key, text).groupBy("__part", "term").agg(
        F.collect_list(F.struct(col(key).alias("k"), "tf")).alias("found"))
    total = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    df = F.sum(F.size("k")).over(Window.partitionBy("term"))
    # Keys and counts as two plain arrays take a third of the room of an array of rows.
    lists = lists.select("term", F.transform("found", lambda f: f["k"]).alias("k"), F.transform("found", lambda f: f["tf"].cast(
        "int")).alias("tf"))
    weighed = lists.select("term", "k", "tf", F.ln((total + 1) / (df + 1)).alias("idf"))
    return weighed.select("term", "idf", F.explode(F.arrays_zip("k", "tf")).alias("f")).select(
        F.col("f.k").alias(key), "term", (F.col("f.tf") * F.col("idf")).alias("weight"))


def hashed_vectors(weights: DataFrame, key: str, width: int = 256) -> DataFrame:
    """Dense vectors (key, embedding) from term weights. A term's place is its md5's leading 32 bits modulo `width`."""
    place = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long") % width
    placed = weights.groupBy(col(key), place.cast("int").alias("place")).agg(F.sum("weight").alias("w"))
    packed = placed.groupBy(col(key)).agg(F.collect_list(F.struct("place", "w")).alias("m"))

    @F.pandas_udf("array<float>")
    def dense(places: pd.Series, sums: pd.Series) -> pd.Series:
        rows = np.zeros((len(places), width), dtype=np.float32)
        for row, p, w in zip(rows, places, sums):
            row[p] = w
        return pd.Series(list(rows))

    return packed.select(col(key), dense(F.col("m.place"), F.col("m.w")).alias("embedding"))


def embed_text(docs: DataFrame, key: str, text: str, width: int = 256, fitted: DataFrame | None = None) -> DataFrame:
    """Built-in embedding of texts; a column of model embeddings can take its place.

    Texts to search with are embedded with the weights of the corpus (`fit_terms`), so that both sides compare.
    """
    weights = term_weights(docs, key, text) if fitted is None else weigh_terms(docs, key, text, fitted)
    return hashed_vectors(weights, key, width)
