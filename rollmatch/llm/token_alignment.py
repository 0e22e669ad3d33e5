"""Which tokens of two tokenizers stand for the same bytes, corpus-wide, from inverted bitmaps of documents per token pair.

Documents are numbered, CHUNK numbers to a chunk. Each pair of token ids that ends at the same byte has, per chunk, a
posting: compressed bitmaps of the chunk's documents, one for each binary digit of how often a document holds the pair
(multiplicity planes). Parts of a posting are OR-merged and their bits counted: documents per pair, and links per pair as
the sum of 2^k times the bits of plane k. The same postings then lead a pair's counts back to its documents, chunk by
chunk, so no link is ever shuffled on its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.session import cut, scratch_path

CHUNK_BITS = 12
CHUNK = 1 << CHUNK_BITS
DENSE = CHUNK // 16         # documents from which a plane is a bitmap of that many 16-bit words rather than a list
TEXT_BYTES = 2 << 20        # of text encoded at a time
FLUSH_LINKS = 2_000_000     # links held before postings are written
PAIR_BITS = 24              # the second tokenizer's id in a pair's number

DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BOTH = f"kind int, number long, id long, {DOCUMENT}, pair long, chunk long, planes binary"
POSTING = "pair long, chunk long, n_documents long, n_links long, planes binary"


class Tokens:
    """Both tokenizers with the bytes of their tokens, one per Python worker."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        import sentencepiece
        import tiktoken
        from public_tokenizers import PATTERN

        model = json.loads(byte_level)
        names = {id_: name for name, id_ in model["model"]["vocab"].items()}
        special = {t["id"] for t in model["added_tokens"] if t["special"]}
        spelled = _byte_letters()
        ranks = {bytes(spelled[c] for c in name): id_ for id_, name in names.items() if id_ not in special}
        # The vocabulary's ids are in the order of its merges, so ids are ranks, and special strings are plain text.
        self.first = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = [b""] * (max(names) + 1)
        for raw, id_ in ranks.items():
            self.bytes_a[id_] = raw
        self.bytes_b = [_piece(self.second, i) for i in range(self.second.get_piece_size())]
        self.size_a = np.array([len(b) for b in self.bytes_a])
        self.size_b = np.array([len(b) for b in self.bytes_b])
        # A token's text in the list of groups, by 2 * id + whether the group ends with it.
        self.shown_a = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_a)) for end in ",|"], dtype=object)
        self.shown_b = np.array([f"{i}{end}".encode() for i in range(len(self.bytes_b)) for end in ",;"], dtype=object)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by both, or None when the bytes of either differ from the text after a blank (or there is no text)."""
        if not text:
            return None
        raw = b" " + text.encode()
        b = self.second.encode(text)
        if b"".join([self.bytes_b[i] for i in b]) != raw:
            return None
        a = self.first.encode_to_numpy(" " + text, disallowed_special=())
        if self.size_a[a].sum() != len(raw) or b"".join([self.bytes_a[i] for i in a.tolist()]) != raw:
            return None
        return a.astype(np.int64), np.array(b, dtype=np.int64)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1, then those from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return {chr(b) if b in printable else chr(next(others)): b for b in range(256)}


def _piece(model, i: int) -> bytes:
    piece = model.id_to_piece(i)
    return bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()


_TOKENS: dict[bytes, Tokens] = {}


def tokens(byte_level: str, pieces: bytes) -> Tokens:
    key = hashlib.sha256(byte_level.encode() + pieces).digest()
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = Tokens(byte_level, pieces)
    return _TOKENS[key]


def align(known: Tokens, encoded: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links, digest of the groups) per document, and each link's pair and document.

    The documents' tokens lie one behind the other, so that one pass over byte offsets serves all of them.
    """
    a, b = (np.concatenate([e[k] for e in encoded]) for k in (0, 1))
    n_a, n_b = (np.array([len(e[k]) for e in encoded]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(known.size_a[a]), np.cumsum(known.size_b[b])
    mark = np.zeros(ends_a[-1] + 1, dtype=bool)
    mark[ends_a] = True
    last_b = mark[ends_b]
    mark[:] = False
    mark[ends_b] = True
    last_a = mark[ends_a]
    document = np.repeat(np.arange(len(encoded)), n_a)[last_a]
    # Where each token goes when groups follow each other, the first tokenizer's tokens in front of the second's.
    count_a, count_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    before = np.concatenate([[0], count_b])[np.cumsum(last_a) - last_a]
    upto = count_a[np.cumsum(last_b) - last_b]
    shown = np.empty(len(a) + len(b), dtype=object)
    shown[np.arange(len(a)) + before] = known.shown_a[2 * a + last_a]
    shown[np.arange(len(b)) + upto] = known.shown_b[2 * b + last_b]
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    groups = np.bincount(document, minlength=len(encoded)).tolist()
    rows = []
    for i, (x, y, n) in enumerate(zip(n_a.tolist(), n_b.tolist(), groups)):
        listed = b"".join(shown[bounds[i]:bounds[i + 1]].tolist())[:-1]
        rows.append((x, y, n, n, hashlib.sha256(listed).hexdigest()))
    return rows, (a[last_a] << PAIR_BITS) | b[last_b], document


def postings(pair: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Pairs and their planes, from one entry per link: the pair and the document's place in its chunk.

    Planes are 16-bit words. Each begins with its number of documents, n; then follow the n places in order, or from DENSE
    documents on the chunk's bitmap.
    """
    found, times = np.unique((pair << CHUNK_BITS) | slot, return_counts=True)
    pairs, owner = np.unique(found >> CHUNK_BITS, return_inverse=True)
    most = np.zeros(len(pairs), dtype=np.int64)
    np.maximum.at(most, owner, times)
    planes = np.frexp(most)[1].astype(np.int64)       # binary digits of the greatest multiplicity
    first = np.cumsum(planes) - planes
    plane, place = [], []
    for k in range(int(planes.max())):
        rows = np.flatnonzero(times >> k & 1)
        plane.append(first[owner[rows]] + k)
        place.append(found[rows] & (CHUNK - 1))
    plane, place = np.concatenate(plane), np.concatenate(place)
    order = np.argsort(plane, kind="stable")
    return pairs, _packed(plane[order], place[order], int(planes.sum()), np.append(first, planes.sum()))


def _packed(plane: np.ndarray, place: np.ndarray, n_planes: int, first: np.ndarray) -> pa.Array:
    """Binary values, one per run of planes first[i] to first[i + 1], from places sorted by plane."""
    n = np.bincount(plane, minlength=n_planes)
    held = np.where(n < DENSE, n, DENSE)
    start = np.concatenate([[0], np.cumsum(held + 1)])
    words = np.zeros(start[-1], dtype="<u2")
    words[start[:-1]] = n
    rank = np.arange(len(plane)) - np.repeat(np.cumsum(n) - n, n)
    sparse = n[plane] < DENSE
    words[start[plane[sparse]] + 1 + rank[sparse]] = place[sparse]
    full = ~sparse
    np.bitwise_or.at(words, start[plane[full]] + 1 + (place[full] >> 4), (1 << (place[full] & 15)).astype("<u2"))
    offsets = (2 * start[first]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(words)])


def opened(planes: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, row, place) of every set bit, plane after plane."""
    offsets = np.frombuffer(planes.buffers()[1], dtype=np.int32)[planes.offset:planes.offset + len(planes) + 1] // 2
    buffer = planes.buffers()[2]
    words = np.frombuffer(buffer, dtype="<u2", count=len(buffer) // 2) if buffer else np.zeros(0, dtype="<u2")
    at, end = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    row = np.arange(len(planes))
    k = 0
    while len(row := row[at[row] < end[row]]):
        n = words[at[row]].astype(np.int64)
        sparse, full = n < DENSE, row[n >= DENSE]
        few = n[sparse]
        spread = np.repeat(at[row[sparse]] + 1 - (np.cumsum(few) - few), few) + np.arange(few.sum())
        rows, places = [np.repeat(row[sparse], few)], [words[spread].astype(np.int64)]
        if len(full):
            maps = words[at[full, None] + 1 + np.arange(DENSE)].astype("<u2").view(np.uint8)
            which, place = np.nonzero(np.unpackbits(maps, axis=1, bitorder="little"))
            rows.append(full[which])
            places.append(place)
        yield k, np.concatenate(rows), np.concatenate(places)
        at[row] += 1 + np.where(sparse, n, DENSE)
        k += 1


def merged(pair: np.ndarray, chunk: np.ndarray, planes: pa.Array) -> pa.RecordBatch:
    """Parts of one posting OR-merged plane by plane, with their bits counted: documents and links.

    A document's links are all in one part, so the parts' bits are of different documents.
    """
    new = np.concatenate([[True], (pair[1:] != pair[:-1]) | (chunk[1:] != chunk[:-1])])
    owner = np.cumsum(new) - 1
    n = int(owner[-1]) + 1
    documents, links, depth, bits = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), []
    for k, row, place in opened(planes):
        target = owner[row]
        bits.append((k, target, place))
        np.add.at(links, target, 1 << k)
        np.maximum.at(depth, target, k + 1)
    every = np.unique(np.concatenate([(t << CHUNK_BITS) | p for _, t, p in bits]))
    np.add.at(documents, every >> CHUNK_BITS, 1)
    first = np.cumsum(depth) - depth
    plane = np.concatenate([first[t] + k for k, t, _ in bits])
    place = np.concatenate([p for _, _, p in bits])
    order = np.lexsort((place, plane))
    joined = _packed(plane[order], place[order], int(depth.sum()), np.append(first, depth.sum()))
    return pa.RecordBatch.from_arrays(
        [pa.array(pair[new]), pa.array(chunk[new]), pa.array(documents), pa.array(links), joined],
        names=["pair", "chunk", "n_documents", "n_links", "planes"])


def _scan(byte_level, pieces):
    """One pass over numbered texts: a row per document, and parts of postings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens(byte_level.value, pieces.value)
        schema = pa.schema([("kind", pa.int32()), ("number", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()),
                            ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                            ("groups_sha256", pa.string()), ("pair", pa.int64()), ("chunk", pa.int64()), ("planes", pa.binary())])

        def batch_of(n: int, **given) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type)
                                               for f in schema], schema=schema)

        pairs, slots, held, chunk = [], [], 0, None

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal pairs, slots, held
            if held:
                found, planes = postings(np.concatenate(pairs), np.concatenate(slots))
                yield batch_of(len(found), kind=np.ones(len(found), np.int32), pair=found,
                               chunk=np.full(len(found), chunk), planes=planes)
            pairs, slots, held = [], [], 0

        for numbers, ids, texts in _portions(batches):
            encoded = [known.encode(t) for t in texts]
            usable = [i for i, e in enumerate(encoded) if e is not None]
            rows = [(0, 0, 0, 0, "")] * len(texts)
            if usable:
                found, pair, document = align(known, [encoded[i] for i in usable])
                for i, row in zip(usable, found):
                    rows[i] = row
                number = np.array(numbers)[usable][document]
                at = number >> CHUNK_BITS
                for value in np.unique(at):
                    if value != chunk or held >= FLUSH_LINKS:
                        yield from flushed()
                        chunk = value
                    mine = at == value
                    pairs.append(pair[mine])
                    slots.append(number[mine] & (CHUNK - 1))
                    held += int(mine.sum())
            columns = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"), map(list, zip(*rows))))
            yield batch_of(len(rows), kind=np.zeros(len(rows), np.int32), number=numbers, id=ids, **columns)
        yield from flushed()

    return run


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for values in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                for column, value in zip(held, values):
                    column.append(value)
                size += len(values[2] or "")
                if size >= TEXT_BYTES:
                    yield held
                    held, size = ([], [], []), 0
    if held[0]:
        yield held


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by pair and chunk; a posting whose parts cross the end of a batch waits for the next one."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        pair, chunk = (rows.column(c).to_numpy() for c in ("pair", "chunk"))
        done = np.flatnonzero((pair != pair[-1]) | (chunk != chunk[-1]))
        open_from = int(done[-1]) + 1 if len(done) else 0
        if open_from:
            yield merged(pair[:open_from], chunk[:open_from], rows.column("planes").slice(0, open_from).combine_chunks())
        rest = rows.slice(open_from)
    if rest is not None and rest.num_rows:
        yield merged(rest.column("pair").to_numpy(), rest.column("chunk").to_numpy(), rest.column("planes").combine_chunks())


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of pairs led back along their postings to the documents of each chunk."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        values, local = np.unique(batch.column("chunk").to_numpy(), return_inverse=True)
        count = batch.column("count").to_numpy()
        best = batch.column("best").to_numpy()
        total = np.zeros((3, len(values) * CHUNK), dtype=np.int64)
        for k, row, place in opened(batch.column("planes")):
            at = local[row] * CHUNK + place
            np.add.at(total[0], at, count[row] << k)
            np.add.at(total[1], at, best[row] << k)
            total[2][at] = 1
        for i, value in enumerate(values.tolist()):
            part = total[:, i * CHUNK:(i + 1) * CHUNK]
            sums[value] = sums[value] + part if value in sums else part.copy()
    for chunk, (count_sum, n_best, seen) in sums.items():
        place = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array((chunk << CHUNK_BITS) + place), pa.array(count_sum[place]),
                                          pa.array(n_best[place])], names=["number", "count_sum", "n_best"])


class Alignment:
    """The scan of a corpus, written: `documents`, one row each, and `postings`, OR-merged and counted."""

    def __init__(self, docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
        spark = docs.sparkSession
        # Tokenizer files are of fixed size and are sent along: executors need no such file.
        with open(byte_level_path, encoding="utf-8") as a, open(pieces_path, "rb") as b:
            files = spark.sparkContext.broadcast(a.read()), spark.sparkContext.broadcast(b.read())
        numbered = docs.select(F.monotonically_increasing_id().alias("number"), col(id_col).cast("long").alias("id"),
                               col(text_col).cast("string").alias("text"))
        path = scratch_path(spark, "alignment")
        (numbered.mapInArrow(_scan(*files), BOTH).write.partitionBy("kind").option("compression", "zstd").parquet(path))
        scanned = spark.read.schema(BOTH).parquet(path)
        self.documents = scanned.where("kind = 0").select("number", "id", *[f.split()[0] for f in DOCUMENT.split(", ")])
        parts = scanned.where("kind = 1").select("pair", "chunk", "planes")
        # Parts meet by pair and chunk: a pair of a third of all documents is as many small postings as it has chunks.
        self.postings = cut(parts.repartition("pair", "chunk").sortWithinPartitions("pair", "chunk").mapInArrow(_merge, POSTING))

    def pairs(self) -> DataFrame:
        """(a, b, n_documents, n_links, best): best if no other a has more links with b."""
        counts = self.postings.groupBy("pair").agg(F.sum("n_documents").alias("n_documents"), F.sum("n_links").alias("n_links"))
        split = counts.select(F.shiftright("pair", PAIR_BITS).alias("a"), F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1).alias("b"),
                              "pair", "n_documents", "n_links")
        most = split.groupBy("b").agg(F.max("n_links").alias("most"))
        return split.join(most, "b").select("pair", "a", "b", "n_documents", "n_links",
                                            (F.col("n_links") == F.col("most")).alias("best"))

    def scores(self) -> DataFrame:
        """(number, count_sum, n_best) of documents with links."""
        counts = self.pairs().select("pair", F.col("n_links").alias("count"), F.col("best").cast("long").alias("best"))
        back = self.postings.join(counts, "pair").select("chunk", "planes", "count", "best")
        return back.repartition("chunk").mapInArrow(_scored, "number long, count_sum long, n_best long")


def align_tokens(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row of the input: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A text that is null, empty, or not given back byte for byte by both tokenizers has no tokens: zeros and an empty
    digest. Repeated rows are rows of their own, and count. Special tokens' strings are plain text. An empty table gives no
    rows; other columns are not read.
    """
    found = Alignment(docs, byte_level_path, pieces_path, id_col, text_col)
    zero = F.lit(0).cast("long")
    return found.documents.join(found.scores(), "number", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
