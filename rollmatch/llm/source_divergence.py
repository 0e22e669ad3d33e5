"""How far the sources of a language lie apart in their words, and by which words.

Texts become arrays of terms; CountVectorizer with a minimum document count and the largest integer as vocabulary size
learns each language's vocabulary and turns every text into its exact sparse vector. The vectors are added up per
(language, source), and pairs of sources are evaluated on these sparse sums.

Three things keep this cheap and bounded, and change no result:

* A term is tagged with its language, so that one fit learns the vocabularies of all languages at once.
* CountVectorizer brings its vocabulary to the driver, so terms are dealt over slices by their hash, one slice for each
  SLICE_BYTES of text, each with a fit of its own: a kept term occurs at least `min_df` times, so a slice's vocabulary is
  at most a third of the text in it, and in a natural language far less. Slices share no terms; together they cover all.
* A text's terms are handed over once per binary digit of their counts, and its vector is the sum of 2^k times the vector
  of digit k. For the fit, texts worked on together are handed over as `min_df` layers, layer j with the terms that
  more than j of them hold: whether at least `min_df` texts hold a term is seen as well from these. The layers of all
  texts meet by the hash of their terms and are layered again, so that the fit counts a term `min_df` times at most.
* Sums of vectors leave a task as arrays, one for a source and BLOCK numbers of terms, and are added up as arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.session import cut, scratch_path
from rollmatch.sources.tabs import path_exists

MIN_DF = 3
SLICE_BYTES = 512 << 20   # of text
MOST_SLICES = 4096
FLUSH_BYTES = 8 << 20     # of text worked on at a time
FLUSH_ENTRIES = 4_000_000  # of vectors added up, or of layers met, at a time
CELLS = 128               # parts of a slice in which the layers of terms meet
BLOCK_BITS = 14
MOST_TERMS = 2 ** 31 - 1
SCALE = 1_000_000_000
TOP = 200
FIT, VECTOR = 0, 1
TERMS = "kind int, slice int, lang string, source string, weight long, terms array<string>"
PACKED = "lang string, source string, block int, index array<int>, n array<long>"
SUMS = "lang string, source string, id long, n long"

# A to Z become small letters, letters and all bytes beyond ASCII stay, everything else separates terms.
_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list]]:
    """Languages, sources and texts (bytes) of some FLUSH_BYTES of text at a time."""
    held: tuple[list, list, list] = ([], [], [])
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(),
                                          part.column(2).cast(pa.binary()).to_pylist()):
                for values, value in zip(held, (lang, source, text)):
                    values.append(value)
                size += len(text)
                if size >= FLUSH_BYTES:
                    yield held
                    held, size = ([], [], []), 0
    if held[0]:
        yield held


def _runs(key: np.ndarray, codes: np.ndarray, tagged: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """First places of the runs of equal keys, and each run's terms as a list."""
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return starts, pa.ListArray.from_arrays(pa.array(np.append(starts, len(codes)), pa.int32()), tagged.take(pa.array(codes)))


def _layers(texts: np.ndarray, min_df: int) -> Iterator[np.ndarray]:
    """Layer by layer, the places of the terms that more texts hold than there are layers before."""
    for layer in range(min(min_df, int(texts.max()))):
        yield np.flatnonzero(texts > layer)


def _split(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The number of its text, and the term, of each occurrence."""
    found = pc.ascii_split_whitespace(pa.array([t.translate(_LETTERS) for t in texts], pa.string()))
    terms = found.flatten()
    filled = pc.greater(pc.binary_length(terms), 0)
    document = np.repeat(np.arange(len(texts)), found.value_lengths().to_numpy(zero_copy_only=False))
    return document[filled.to_numpy(zero_copy_only=False)], terms.filter(filled)


def _handed_over(document: np.ndarray, terms: pa.Array, tag: str, slices: int, min_df: int):
    """(kind, slice, document, weight, terms) columns for some texts of one language; weight is the cell in the layers."""
    coded = terms.dictionary_encode()
    known = coded.dictionary
    hashed = np.array([zlib.crc32(t) for t in known.cast(pa.binary()).to_pylist()], dtype=np.int64)
    # Terms are numbered slice by slice, and cell by cell in it, so that a text's sorted terms lie slice by slice.
    cell = hashed % slices * CELLS + hashed // slices % CELLS
    order = np.argsort(cell, kind="stable")
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    cell = cell[order]
    part = cell // CELLS
    tagged = pc.binary_join_element_wise(known.take(pa.array(order)), tag, "")
    held, times = np.unique(document * len(known) + number[coded.indices.to_numpy()], return_counts=True)
    document, code = held // len(known), held % len(known)
    for k in range(int(times.max()).bit_length()):
        rows = np.flatnonzero(times >> k & 1)
        key = document[rows] * slices + part[code[rows]]
        starts, lists = _runs(key, code[rows], tagged)
        yield VECTOR, key[starts] % slices, key[starts] // slices, 1 << k, lists
    for rows in _layers(np.bincount(code, minlength=len(known)), min_df):
        starts, lists = _runs(cell[rows], rows, tagged)
        yield FIT, part[rows][starts], np.zeros(len(starts), np.int64), cell[rows][starts] % CELLS, lists


def tagged_terms(docs: DataFrame, slices: int, min_df: int = MIN_DF, text_col: str = "text", lang_col: str = "lang",
                 source_col: str = "source") -> DataFrame:
    """(kind, slice, lang, source, weight, terms): what the fit and the vectors of each slice are made from.

    Terms are runs of characters other than U+0000-0040, 005B-0060 and 007B-007F, with A to Z as small letters. The tag
    begins with a tab, which is in no term. Null text, language and source are empty; a text without terms gives no row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, sources, texts in _pieces(batches):
            by_lang: dict[str, list[int]] = {}
            for i, lang in enumerate(langs):
                by_lang.setdefault(lang, []).append(i)
            for lang, rows in by_lang.items():
                occurring, found = _split([texts[i] for i in rows])
                if not len(found):
                    continue
                named = pa.array([sources[i] for i in rows], pa.string())
                for kind, part, document, weight, lists in _handed_over(occurring, found, "\t" + lang, slices, min_df):
                    n = len(lists)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, kind, np.int32)), pa.array(part.astype(np.int32)), pa.array([lang] * n, pa.string()),
                         named.take(pa.array(document)), pa.array(np.broadcast_to(np.int64(weight), n)), lists],
                        names=["kind", "slice", "lang", "source", "weight", "terms"])

    text = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)]
    return docs.select(*[t.alias(f"c{i}") for i, t in enumerate(text)]).mapInArrow(run, TERMS)


def _slices(docs: DataFrame, text_col: str = "text") -> int:
    size = docs.agg(F.sum(F.octet_length(col(text_col).cast("string")))).first()[0] or 0
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def _met(layers: DataFrame, min_df: int) -> DataFrame:
    """Layers again, of the terms of all texts: one of `min_df` texts or more is in `min_df` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def flushed() -> Iterator[pa.RecordBatch]:
            coded = pa.concat_arrays(held).dictionary_encode()
            held.clear()
            if len(coded):
                for rows in _layers(np.bincount(coded.indices.to_numpy()), min_df):
                    yield pa.RecordBatch.from_arrays(
                        [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), coded.dictionary.take(pa.array(rows)))],
                        names=["terms"])

        for batch in batches:
            held.append(batch.column(0).flatten())
            if sum(map(len, held)) >= FLUSH_ENTRIES:
                yield from flushed()
        if held:
            yield from flushed()

    return layers.repartition("weight").select("terms").mapInArrow(run, "terms array<string>")


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of sparse vectors per language and source, as arrays."""
    groups: dict[tuple[str, str], int] = {}
    keys, counts, held = [], [], 0

    def flushed() -> Iterator[pa.RecordBatch]:
        nonlocal keys, counts, held
        if held:
            key, count = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            sums, key = np.add.reduceat(count[order], starts), key[starts]
            first = np.flatnonzero(np.diff(key >> BLOCK_BITS, prepend=-1))
            owner = pa.array(key[first] >> 32)
            names = [pa.array([g[i] for g in groups], pa.string()).take(owner) for i in (0, 1)]
            index = (key & 0xFFFFFFFF).astype(np.int32)
            bounds = pa.array(np.append(first, len(key)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(index[first] >> BLOCK_BITS), pa.ListArray.from_arrays(bounds, pa.array(index)),
                 pa.ListArray.from_arrays(bounds, pa.array(sums))], names=["lang", "source", "block", "index", "n"])
        keys, counts, held = [], [], 0

    for batch in batches:
        lang, source, weight, indices, values = batch.columns
        group = np.array([groups.setdefault(g, len(groups)) for g in zip(lang.to_pylist(), source.to_pylist())], dtype=np.int64)
        n = pc.list_value_length(indices).to_numpy(zero_copy_only=False).astype(np.int64)
        keys.append(np.repeat(group << 32, n) | indices.flatten().to_numpy())
        counts.append(np.repeat(weight.to_numpy(), n) * values.flatten().to_numpy().astype(np.int64))
        held += int(n.sum())
        if held >= FLUSH_ENTRIES:
            yield from flushed()
    yield from flushed()


def _summed(packed: DataFrame, number: int) -> DataFrame:
    """(lang, source, id, n) of a slice from its arrays; a task holds one block of one source at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(1 << BLOCK_BITS, dtype=np.int64)

        def flushed() -> Iterator[pa.RecordBatch]:
            used = np.flatnonzero(sums)
            if len(used):
                names = [pa.repeat(pa.scalar(name, pa.string()), len(used)) for name in at[:2]]
                ids = used + ((number << 32) + (at[2] << BLOCK_BITS))
                yield pa.RecordBatch.from_arrays([*names, pa.array(ids), pa.array(sums[used])], names=["lang", "source", "id", "n"])
            sums[:] = 0

        for batch in batches:
            lang, source, block, index, n = batch.columns
            bounds, index, n = np.append(0, np.cumsum(index.value_lengths())), index.flatten().to_numpy(), n.flatten().to_numpy()
            for i, key in enumerate(zip(lang.to_pylist(), source.to_pylist(), block.to_pylist())):
                if key != at:
                    yield from flushed()
                    at = key
                own = slice(bounds[i], bounds[i + 1])
                sums[index[own] & ((1 << BLOCK_BITS) - 1)] += n[own]  # an array holds a number once
        yield from flushed()

    key = ["lang", "source", "block"]
    return packed.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, SUMS)


def _slice_tables(fit: DataFrame, vectors: DataFrame, number: int, min_df: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, id, n), the sums of a slice's vectors, and (id, term), its vocabulary."""
    spark = fit.sparkSession
    # An empty term in enough rows: a fit of terms that are all too rare would otherwise be an error.
    guard = spark.range(min_df).select(F.array(F.lit("")).alias("terms"))
    fitted = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MOST_TERMS).fit(
        _met(fit, min_df).unionByName(guard))
    # The model's own file, so that the vocabulary does not pass through Python.
    saved = scratch_path(spark, "model")
    fitted.save(saved)
    vocabulary = spark.read.parquet(f"{saved}/data").select(F.posexplode("vocabulary").alias("index", "tagged")).select(
        (F.col("index") + F.lit(number << 32)).alias("id"), F.substring_index("tagged", "\t", 1).alias("term"))
    vector = F.unwrap_udt("vector")
    packed = fitted.transform(vectors).select("lang", "source", "weight", vector["indices"].alias("indices"),
                                              vector["values"].alias("values")).mapInArrow(_added_up, PACKED)
    return _summed(packed, number), vocabulary.where("term <> ''")


def term_counts(docs: DataFrame, min_df: int = MIN_DF, slices: int | None = None, **columns: str) -> tuple[DataFrame, DataFrame]:
    """(lang, source, id, n): how often a source uses each term that at least `min_df` texts of its language hold; and
    (id, term), the vocabulary.

    Both written, slice by slice. Two languages' terms of one spelling have two numbers.
    """
    spark = docs.sparkSession
    slices = slices or _slices(docs, columns.get("text_col", "text"))
    dealt, sums, known = (scratch_path(spark, name) for name in ("terms", "sums", "vocabulary"))
    tagged_terms(docs, slices, min_df, **columns).write.partitionBy("kind", "slice").parquet(dealt)
    schema = "lang string, source string, weight long, terms array<string>"
    for number in range(slices):
        fit, vectors = (f"{dealt}/kind={kind}/slice={number}" for kind in (FIT, VECTOR))
        if path_exists(spark, vectors):
            tables = _slice_tables(*(spark.read.schema(schema).parquet(path) for path in (fit, vectors)), number, min_df)
            for table, path in zip(tables, (sums, known)):
                table.write.mode("append").parquet(path)
    shapes = (sums, "lang string, source string, id long, n long"), (known, "id long, term string")
    return tuple(spark.read.schema(s).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], s)
                 for path, s in shapes)


def _share(count: str, total: str, scale: int, add: int) -> str:
    """1 + floor(scale * (count + add) / total), exact: decimals do not overflow where a long would."""
    return f"1 + (CAST({count} + {add} AS DECIMAL(20, 0)) * {scale}) div greatest({total}, 1)"


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def group_sizes(docs: DataFrame, counts: DataFrame, scale: int = SCALE, add: int = 1, lang_col: str = "lang",
                source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Per (lang, source) that occurs: its number `group`, `total` = its words plus the smoothing, `none` = share
    of an unused term, `used` terms and `v`, the language's vocabulary; and per id the language's own share `q`."""
    text = [F.coalesce(col(c).cast("string"), F.lit("")) for c in (lang_col, source_col)]
    groups = cut(docs.select(text[0].alias("lang"), text[1].alias("source")).distinct()).withColumn(
        "group", F.monotonically_increasing_id())
    terms = cut(counts.groupBy("lang", "id").agg(F.sum("n").alias("n")))
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"))
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("used"))
    sized = (groups.join(own, ["lang", "source"], "left").join(langs.select("lang", "v"), "lang", "left")
             .select("lang", "source", "group", F.coalesce("used", F.lit(0)).alias("used"), F.coalesce("v", F.lit(0)).alias("v"),
                     F.expr(f"coalesce(n, 0) + {add} * coalesce(v, 0)").alias("total"))
             .withColumn("none", F.expr(_share("0", "total", scale, add))))
    shares = terms.join(langs.selectExpr("lang", f"n + {add} * v AS total"), "lang").select(
        "id", F.expr(_share("n", "total", scale, add)).alias("q"))
    return cut(sized), shares


def source_pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of sources of a language, over all of its kept terms.

    shares: (group, id, p, none) of used terms. The sum over all terms is that over the terms the one uses, as if the
    other used none, plus the same the other way round, plus that of the terms neither uses; terms that both use are
    met by a join and corrected. So work follows the terms in use, not vocabulary times pairs.
    """
    one = shares.select("id", "group", "p", "none")
    two = shares.selectExpr("id", "group AS other", "p AS q", "none AS q_none")
    # Each pair is met once, for both of its directions.
    there = f"{_gap('p', 'q')} - {_gap('p', 'q_none')} - {_gap('none', 'q')} + {_gap('none', 'q_none')}"
    back = f"{_gap('q', 'p')} - {_gap('q', 'none')} - {_gap('q_none', 'p')} + {_gap('q_none', 'none')}"
    both = one.join(two, "id").where("group < other").groupBy("group", "other").agg(
        F.sum(F.expr(there)).alias("there"), F.sum(F.expr(back)).alias("back"))
    both = both.select(F.inline(F.array(F.struct("group", "other", F.col("there").alias("shared")),
                                        F.struct(F.col("other").alias("group"), F.col("group").alias("other"), F.col("back").alias("shared")))))
    # Terms of one share count alike, so a source is met with the others by its distinct shares only.
    levels = shares.groupBy("group", "p").agg(F.count(F.lit(1)).alias("terms")).join(groups.select("group", "lang"), "group")
    others = groups.selectExpr("lang", "group AS other", "none")
    alone = (levels.join(others, "lang").where("group <> other").groupBy("group", "other").agg(
        F.sum(F.expr(f"terms * ({_gap('p', 'none')})")).alias("ahead"),
        F.sum(F.expr(f"terms * ({_gap('none', 'p')})")).alias("behind")))
    pairs = groups.join(groups.selectExpr("lang", "source AS item", "group AS other", "used AS q_used", "none AS q_none"), "lang")
    met = (pairs.where("group <> other").join(alone.select("group", "other", "ahead"), ["group", "other"], "left")
           .join(alone.selectExpr("other AS group", "group AS other", "behind"), ["group", "other"], "left")
           .join(both, ["group", "other"], "left"))
    rest = f"(v - used - q_used) * ({_gap('none', 'q_none')})"
    return met.select("lang", "source", "item", F.expr(
        f"CASE WHEN v = 0 THEN 0 ELSE coalesce(ahead, 0) + coalesce(behind, 0) + coalesce(shared, 0) + {rest} END").alias("value"))


def audit(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, scale: int = SCALE, add: int = 1,
          slices: int | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) of the columns text, lang and source; null is empty in each.

    Part `pair`: the divergence from each other source of the language, all ranks. Part `term`: the `top` terms that a
    source uses beyond its language's share. Equal values are ranked by the item's bytes. A source without terms
    has its pairs, a language of one source has none; an empty table gives no rows. Other columns are not read.
    """
    counts, vocabulary = term_counts(docs, min_df, slices)
    groups, shares = group_sizes(docs, counts, scale, add)
    own = cut(counts.join(groups.select("lang", "source", "group", "total", "none"), ["lang", "source"]).select(
        "group", "id", "none", F.expr(_share("n", "total", scale, add)).alias("p")))
    pairs = source_pairs(own, groups)
    # Ties at the last rank are told apart by their terms, so all of them meet the vocabulary, and no others do.
    by_value = Window.partitionBy("group").orderBy(F.desc("value"))
    high = (own.join(shares, "id").where("p > q").select("group", "id", F.expr(_gap("p", "q")).alias("value"))
            .withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top))
    terms = high.join(vocabulary, "id").join(groups, "group").select("lang", "source", F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [found.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(part))
              for part, found in (("pair", pairs), ("term", terms))]
    ranked[1] = ranked[1].where(F.col("rank") <= top)
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")
