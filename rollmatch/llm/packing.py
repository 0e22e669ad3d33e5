"""Packing documents into fixed-length sequences by length patterns.

Packing looks at lengths only, and these are at most as many as a sequence is long, so the plan is made on a histogram
however many documents there are. Lengths are put into bins, every pattern of up to three bins that fills a sequence
is a candidate, and non-negative least squares fits how often each is to be repeated. Repeats are rounded, laid out with
the exact lengths, and what the fit leaves over is packed best-fit into the smallest room, longest first.

The plan is a table of runs: pieces number `first` and on of one length go to sequences `base` and on, at one offset.
Pieces get numbers within their length in slices (length, hash range), so a very frequent length is many small windows.
"""

from __future__ import annotations

import functools
import string
import struct
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.common import ROW, with_fields
from rollmatch.session import cut

SEQUENCE = 4096
END_ID = 1
BIN = 8              # tokens per bin of the fit
SLICE_ROWS = 16384
MOST_KNOWN_WORDS = 300_000  # words whose ids a task remembers before it starts anew


def _byte_letters() -> list[str]:
    """How byte-level vocabularies spell a byte: printable Latin-1 as itself, the others from code point 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordIds:
    """Token ids of words (runs without ASCII white space) as bytes, little-endian unsigned 32 bit, remembered.

    The tokenizer splits at white space and handles each part by itself, so a text's ids are its words' ids in a row.
    A new word of letters, perhaps with marks after it, is looked up in the model straight away; any other word goes
    through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer  # loaded in the tasks

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.spelling = dict(enumerate(_byte_letters()))

    def _any(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _part(self, part: str) -> bytes:
        out = self.parts.get(part)
        if out is None:
            spelled = part.encode().decode("latin-1").translate(self.spelling)
            ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
            out = self.parts[part] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _new(self, raw: bytes) -> bytes:
        word = raw.decode()
        letters = word.rstrip(string.punctuation)
        low = letters.lower()
        # Lower case of a Greek capital sigma depends on its place in Python, but not in the tokenizer.
        if len(low) > 256 or not low.isalpha() or not letters.isalpha() or "\u03a3" in letters or not (
                low.isascii() or unicodedata.is_normalized("NFC", letters)):
            return self._any(word)
        marks = word[len(letters):]
        return self._part(low) + self._part(marks) if marks else self._part(low)

    def of(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            # The tokenizer lower-cases, too, but not within its special tokens.
            raw = text.encode()
            words = raw.split() if b"<|" in raw else raw.lower().split()
            if len(self.known) > MOST_KNOWN_WORDS:
                self.known.clear()
            if len(self.parts) > MOST_KNOWN_WORDS:
                self.parts.clear()
            known = self.known
            for word in set(words).difference(known):
                known[word] = self._new(word)
            yield b"".join(map(known.__getitem__, words))


@functools.cache
def word_ids(path: str) -> WordIds:
    """One memory per Python worker, over its tasks."""
    return WordIds(path)


def pieces(docs: DataFrame, tokenizer_path: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: the carried columns other than the text under ROW, piece, start, length, ids_crc32 and, on
    request, the ids. A null text is empty: one piece of the end id alone."""
    carried = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in carried]).alias(ROW), docs[text_col].alias("text"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(tokenizer_path)
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            source, out = [], defaultdict(list)
            texts = batch.column("text").fill_null("").to_pylist()
            for i, ids in enumerate(known.of(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * SEQUENCE)):
                    part = ids[at:at + 4 * SEQUENCE]
                    source.append(i)
                    out["piece"].append(k)
                    out["start"].append(at // 4)
                    out["length"].append(len(part) // 4)
                    out["ids_crc32"].append(zlib.crc32(part))
                    if with_ids:
                        out["ids"].append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = {ROW: batch.column(ROW).take(pa.array(source, pa.int64())), "piece": pa.array(out["piece"], pa.int32()),
                       **{c: pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")}}
            if with_ids:
                columns["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    more = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(cut_up, with_fields(rows, [ROW], f"piece int, start long, length long, ids_crc32 long{more}"))


def patterns(bins: int) -> np.ndarray:
    """All multisets of one to three bins (1 to `bins`) that add up to `bins`, as rows, 0 where a place is unused."""
    out = [(bins, 0, 0)]
    out += [(a, bins - a, 0) for a in range(-(-bins // 2), bins)]
    for a in range(-(-bins // 3), bins - 1):
        rest = bins - a
        out += [(a, b, rest - b) for b in range(-(-rest // 2), min(a, rest - 1) + 1)]
    return np.array(out, dtype=np.int64)


def fit_repeats(histogram: np.ndarray, shapes: np.ndarray, rounds: int = 400, batch: int = 24) -> np.ndarray:
    """Repeats of each pattern, at least 0, that come nearest to the histogram in least squares.

    An active-set method: patterns whose repeats would lower the error most join the active set, some at a
    time; the normal equations are solved on it, and patterns driven to 0 on the way leave it. Patterns are
    kept as their bins, never as a matrix over all bins.
    """
    n = len(histogram)
    target = histogram.astype(float)
    scale = max(target.sum(), 1.0)
    target = target / scale
    weight = np.zeros(len(shapes))
    active = np.zeros(len(shapes), dtype=bool)

    def columns(which: np.ndarray) -> np.ndarray:
        matrix = np.zeros((n, len(which)))
        for k in range(shapes.shape[1]):
            np.add.at(matrix, (shapes[which, k], np.arange(len(which))), shapes[which, k] > 0)
        return matrix

    padded = np.zeros(n)
    for _ in range(rounds):
        which = np.flatnonzero(active)
        residual = target - columns(which) @ weight[which] if len(which) else target.copy()
        padded[:] = residual
        padded[0] = 0.0
        gain = padded[shapes].sum(axis=1)
        gain[active] = -1.0
        best = np.argpartition(gain, -batch)[-batch:]
        best = best[gain[best] > 1e-7]
        if not len(best):
            break
        active[best] = True
        while True:
            which = np.flatnonzero(active)
            matrix = columns(which)
            normal = matrix.T @ matrix
            normal[np.diag_indices_from(normal)] += 1e-9
            solution = np.linalg.solve(normal, matrix.T @ target)
            if (solution > 0).all():
                weight[:] = 0.0
                weight[which] = solution
                break
            old, bad = weight[which], solution <= 0
            step = np.min(old[bad] / np.maximum(old[bad] - solution[bad], 1e-300))
            moved = old + step * (solution - old)
            weight[which] = np.maximum(moved, 0.0)
            active[which[bad & (moved <= 1e-15)]] = False
            weight[~active] = 0.0
    return weight * scale


def _taken(queue: list[list[int]], count: int) -> list[tuple[int, int]]:
    """Take `count` pieces off a queue of [length, pieces]; the runs taken."""
    runs = []
    while count:
        length, there = queue[-1]
        use = min(count, there)
        runs.append((length, use))
        queue[-1][1] -= use
        count -= use
        if not queue[-1][1]:
            queue.pop()
    return runs


def _aligned(slots: list[list[tuple[int, int]]]) -> Iterator[tuple[int, list[int]]]:
    """Groups (sequences, lengths) from runs per slot, cut where any slot's length changes."""
    at, left = [0] * len(slots), [runs[0][1] for runs in slots]
    while True:
        use = min(left)
        yield use, [runs[i][0] for runs, i in zip(slots, at)]
        for k, runs in enumerate(slots):
            left[k] -= use
            if not left[k]:
                at[k] += 1
                if at[k] == len(runs):
                    return
                left[k] = runs[at[k]][1]


def plan_groups(counts: dict[int, int], sequence: int = SEQUENCE, width: int = BIN) -> list[tuple[int, list[int]]]:
    """Groups (number of sequences, lengths in each) that hold all pieces; counts: pieces of each length."""
    bins = sequence // width
    queues: list[list[list[int]]] = [[] for _ in range(bins + 1)]
    for length in sorted(counts):
        queues[-(-length // width)].append([length, counts[length]])
    there = np.array([sum(n for _, n in q) for q in queues], dtype=np.int64)
    shapes = patterns(bins)
    repeats = np.round(fit_repeats(there, shapes)).astype(np.int64)
    groups: list[tuple[int, list[int]]] = []
    for i in np.argsort(-repeats, kind="stable"):
        need = [int(b) for b in shapes[i] if b]
        count = min(int(repeats[i]), *(int(there[b]) // need.count(b) for b in set(need)))
        if count <= 0:
            continue
        for b in need:
            there[b] -= count
        groups += _aligned([_taken(queues[b], count) for b in need])
    # Best fit of the rest: rooms[r] are the groups with r tokens free.
    rooms: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for count, lengths in groups:
        rooms[sequence - sum(lengths)].append((count, lengths))
    free = np.array([r in rooms for r in range(sequence + 1)])
    for length in sorted((x for q in queues for x, n in q if n), reverse=True):
        left = next(n for x, n in queues[-(-length // width)] if x == length)
        while left:
            fits = np.flatnonzero(free[length:sequence])
            if not len(fits):
                each = sequence // length  # new sequences, as many of this length in each as fit
                full, rest = divmod(left, each)
                for count, k in ((full, each), (1, rest)):
                    if count and k:
                        rooms[sequence - k * length].append((count, [length] * k))
                        free[sequence - k * length] = True
                break
            room = length + int(fits[0])
            count, lengths = rooms[room].pop()
            free[room] = bool(rooms[room])
            use = min(count, left)
            if use < count:
                rooms[room].append((count - use, lengths))
                free[room] = True
            rooms[room - length].append((use, [*lengths, length]))
            free[room - length] = True
            left -= use
    return [g for gs in rooms.values() for g in gs]


def plan_runs(counts: dict[int, int]) -> np.ndarray:
    """Runs (length, first, base, offset), sorted: where each length's pieces go, by their number in the length."""
    first: dict[int, int] = defaultdict(int)
    runs, base = [], 0
    for count, lengths in plan_groups(counts):
        offset = 0
        for length in lengths:
            runs.append((length, first[length], base, offset))
            first[length] += count
            offset += length
        base += count
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)


def pack(parts: DataFrame, tie: list[str]) -> DataFrame:
    """Pieces with sequence_id and offset (long). parts: a written table with a column `length` from 1 to SEQUENCE;
    tie: columns that order the pieces of one length. Rows equal in all of them are exchangeable. No pieces, no rows."""
    counts = {int(r.length): int(r.n) for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan_runs(counts)
    slices = max(1, -(-sum(counts.values()) // SLICE_ROWS))
    parts = parts.withColumn("slice", F.pmod(F.xxhash64(*tie), F.lit(slices)).cast("int"))
    sizes = parts.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    place = F.row_number().over(Window.partitionBy("length", "slice").orderBy(*tie)) - 1
    numbered = (parts.withColumn("place", place).join(sizes, ["length", "slice"])
                .withColumn("number", F.col("place") + F.col("earlier")).drop("place", "earlier", "slice"))
    # The plan has some runs per length, a few thousand in all; it goes along with the tasks.
    keys = runs[:, 0] << 48 | runs[:, 1]

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy()
            run = np.searchsorted(keys, batch.column("length").to_numpy() << 48 | number, side="right") - 1
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in batch.schema.names if c != "number"},
                "sequence_id": pa.array(runs[run, 2] + number - runs[run, 1]), "offset": pa.array(runs[run, 3])})

    names = [c for c in numbered.columns if c != "number"]
    return numbered.mapInArrow(laid, with_fields(numbered, names, "sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text", id_col: str = "doc_id",
                   with_ids: bool = False) -> DataFrame:
    """The input's columns but the text, one row per piece, with piece, start, length, ids_crc32, sequence_id, offset
    and, on request, ids.

    Only a document longer than a sequence is cut. A null or empty text is the end id alone; repeated rows are packed
    each; result columns replace those of the same name; an empty table gives none.
    """
    parts = cut(pieces(docs, tokenizer_path, text_col, with_ids))
    own = [c for c in docs.columns if c != text_col]
    packed = pack(parts.withColumn("id", F.col(f"{ROW}.{quoted(id_col)}")), ["id", "piece", "ids_crc32"])
    results = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    return packed.select(*[F.col(f"{ROW}.{quoted(c)}") for c in own if c not in results], *results)
