"""Record roll-up: several rows per record in, one row per record out.

Groups are never gathered row by row in one task: rows are first combined per (key, block of consecutive
order values), in parallel and after map-side combining, and only the combined pieces meet per key.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.functions.columns import block_of, col, cols, listed, quoted, text_literal
from rollmatch.functions.nulls import CONCAT_TOKENS, fill_keyed_rows, null_tokens
from rollmatch.operators.order import BLOCK, ORDER, carry, fill_down
from rollmatch.session import cut

LIST_SEPARATOR = "/-/"


def fill_records(df: DataFrame, key: str, order: str = ORDER, dedupe: bool = True, partitions: int | None = None) -> DataFrame:
    """Rows without a key take their empty cells from the latest keyed row; then exact duplicates go.

    The order column is left out of the comparison and of a deduplicated result.
    """
    data = [c for c in df.columns if c != order]
    empty = _empty_to_null(df)
    has_key = f"nullif(CAST({quoted(key)} AS STRING), '') IS NOT NULL"
    # Rows without a key that all come before the keyed ones, as after a fill-down of the key, have nothing to take.
    nothing = df.agg(F.expr(
        f"count({quoted(order)}) = count(1) AND coalesce(max(CASE WHEN NOT ({has_key}) THEN {quoted(order)} END) "
        f"< min(CASE WHEN {has_key} THEN {quoted(order)} END), true)")).first()[0]
    filled = df
    if not nothing:
        carried = carry(df, {"__head": f"CASE WHEN {has_key} THEN struct({listed(data)}) END"}, order, (), partitions)
        filled = carried.selectExpr(quoted(order), *[
            f"CASE WHEN {has_key} OR __head IS NULL THEN {quoted(c)} ELSE coalesce({empty[c]}, __head.{quoted(c)}) END AS {quoted(c)}"
            for c in data])
    return filled.select(*cols(data)).distinct() if dedupe else filled.select(*cols(df.columns))


def fill_from_row_above(df: DataFrame, order: str = ORDER, dedupe: bool = True, partitions: int | None = None) -> DataFrame:
    """Every empty cell takes the filled cell above it; then exact duplicates go."""
    data = [c for c in df.columns if c != order]
    empty = _empty_to_null(df)
    carried = carry(df, {f"__f{i}": empty[c] for i, c in enumerate(data)}, order, (), partitions)
    filled = carried.selectExpr(quoted(order), *[
        f"coalesce(__f{i}, {quoted(c)}) AS {quoted(c)}" for i, c in enumerate(data)])
    return filled.select(*cols(data)).distinct() if dedupe else filled.select(*cols(df.columns))


def _empty_to_null(df: DataFrame) -> dict[str, str]:
    return {c: f"nullif({quoted(c)}, '')" if kind == "string" else quoted(c) for c, kind in df.dtypes}


def _pieces(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tokens: Sequence[str], order: str, block: int,
            extra: Sequence[Column] = ()) -> DataFrame:
    """Per key and block of row order: the rows' texts as one array sorted by row order, tokens as nulls."""
    words = ", ".join(text_literal(t) for t in tokens)
    cell = "CAST({0} AS STRING)"
    kept = f"CASE WHEN {cell} NOT IN ({words}) THEN {cell} END" if tokens else cell
    fields = ", ".join(f"'v{i}', {kept.format(quoted(c))}" for i, c in enumerate(columns))
    row = f"named_struct('o', {quoted(order)}, {fields})" if columns else f"named_struct('o', {quoted(order)})"
    piece = F.expr(f"{block_of(order, block)} AS piece")
    return df.groupBy(*cols(keys), piece).agg(F.expr(f"sort_array(collect_list({row})) AS __rows"), *extra)


def _present(i: int) -> str:
    return f"filter(transform(__rows, r -> r.v{i}), v -> v IS NOT NULL)"


def _joined(i: int, sep: str) -> str:
    """Text of a piece, null when none of its rows has a value."""
    return f"CASE WHEN exists(__rows, r -> r.v{i} IS NOT NULL) THEN array_join({_present(i)}, {text_literal(sep)}) END"


def _whole(i: int, sep: str) -> str:
    return f"array_join(transform(__all, p -> p.v{i}), {text_literal(sep)})"


def _all_pieces(count: int) -> Column:
    return F.expr(f"sort_array(collect_list(struct({', '.join(['piece', *[f'v{i}' for i in range(count)]])}))) AS __all")


def concat_pieces(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str = ORDER,
                  sep: str = ",", tokens: Sequence[str] = CONCAT_TOKENS, block: int = BLOCK) -> DataFrame:
    """Grouped concatenation left in pieces (one row per key and block, piece null when it has no value).

    This is the whole result too, for groups whose text would not fit one cell.
    """
    pieces = _pieces(df, keys, columns, tokens, order, block)
    return pieces.selectExpr(*cols(keys), "piece", *[f"{_joined(i, sep)} AS {quoted(c)}" for i, c in enumerate(columns)])


def concat_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str = ORDER,
                sep: str = ",", tokens: Sequence[str] = CONCAT_TOKENS, block: int = BLOCK) -> DataFrame:
    """Per key, each column's non-null values joined in row order; an all-null group gives an empty text."""
    pieces = _pieces(df, keys, columns, tokens, order, block).selectExpr(
        *cols(keys), "piece", *[f"{_joined(i, sep)} AS v{i}" for i in range(len(columns))])
    grouped = pieces.groupBy(*cols(keys)).agg(_all_pieces(len(columns)))
    return grouped.selectExpr(*cols(keys), *[f"{_whole(i, sep)} AS {quoted(c)}" for i, c in enumerate(columns)])


def collect_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str = ORDER,
                 sep: str = LIST_SEPARATOR, tokens: Sequence[str] = ("nan",), block: int = BLOCK) -> DataFrame:
    """Per key, each column's non-null values as a list in row order.

    A value holding `sep` becomes several items, and a group without values becomes a list of one empty text.
    """
    return _collect(df, keys, columns, order, sep, tokens, block, first=())


def collect_pieces(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str = ORDER,
                   sep: str = LIST_SEPARATOR, tokens: Sequence[str] = ("nan",), block: int = BLOCK) -> DataFrame:
    """The lists of `collect_rows` in pieces: one row per key and block of rows, numbered by `piece` in row order.

    For groups too long for one cell. A piece without values is an empty list.
    """
    split = text_literal(re.escape(sep))
    return _pieces(df, keys, columns, tokens, order, block).selectExpr(*cols(keys), "piece", *[
        f"flatten(transform({_present(i)}, v -> split(v, {split}))) AS {quoted(c)}" for i, c in enumerate(columns)])


def _collect(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: str, sep: str,
             tokens: Sequence[str], block: int, first: Sequence[str]) -> DataFrame:
    head = [F.expr(f"min_by(struct({listed(first)}), {quoted(order)}) AS __first")] if first else []
    pieces = _pieces(df, keys, columns, tokens, order, block, head)
    split = text_literal(re.escape(sep))
    pieces = pieces.selectExpr(*cols(keys), "piece", *(["__first"] if first else []), *[
        f"flatten(transform({_present(i)}, v -> split(v, {split}))) AS v{i}" for i in range(len(columns))])
    top = [F.expr("min_by(__first, piece) AS __first")] if first else []
    grouped = pieces.groupBy(*cols(keys)).agg(_all_pieces(len(columns)), *top)
    whole = "flatten(transform(__all, p -> p.v{0}))"
    return grouped.selectExpr(
        *cols(keys), *[f"__first.{quoted(c)} AS {quoted(c)}" for c in first],
        *[f"CASE WHEN exists(__all, p -> size(p.v{i}) > 0) THEN {whole.format(i)} ELSE array('') END AS {quoted(c)}"
          for i, c in enumerate(columns)])


def roll_up_lists(df: DataFrame, fill_columns: Sequence[str], list_columns: Sequence[str], key: str,
                  order: str = ORDER, word: str = "NA", block: int = BLOCK, keep_order: bool = False) -> DataFrame:
    """One row per record: fill columns from its first row, list columns gathered over its rows.

    Rows before the first key form one record of null key, whose lists are null. With `keep_order` a record keeps
    the order value of its first row.
    """
    if key not in fill_columns:
        raise ValueError(f"key column {key!r} must be one of the fill columns")
    narrow = df.select(col(order), *cols(fill_columns), *cols(list_columns))
    keyed = fill_keyed_rows(narrow, key, word, only=[*fill_columns, *list_columns])
    filled = fill_down(keyed, fill_columns, order)
    kept = [*([order] if keep_order else []), *[c for c in fill_columns if c != key]]
    rolled = _collect(filled, [key], list_columns, order, LIST_SEPARATOR, ("nan",), block, first=kept)
    return rolled.selectExpr(*cols([order] if keep_order else []), *cols(fill_columns), *[
        f"CASE WHEN {quoted(key)} IS NOT NULL THEN {quoted(c)} END AS {quoted(c)}" for c in list_columns])


def roll_up_items(df: DataFrame, fill_columns: Sequence[str], list_columns: Sequence[str], key: str, order: str = ORDER,
                  word: str = "NA", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """`roll_up_lists` for records of any length: (one row per record with its fill columns, its list items).

    Items are rows (key, name of the list column, at = place in the list from 0, value), so no cell holds more than the
    rows of one block. A list without values is one empty text; the record of null key has no items.
    """
    if key not in fill_columns:
        raise ValueError(f"key column {key!r} must be one of the fill columns")
    narrow = df.select(col(order), *cols(fill_columns), *cols(list_columns))
    filled = cut(fill_down(fill_keyed_rows(narrow, key, word, only=[*fill_columns, *list_columns]), fill_columns, order))
    records = filled.groupBy(col(key)).agg(F.expr(
        f"min_by(struct({listed(c for c in fill_columns if c != key)}), {quoted(order)}) AS r"))
    records = records.select(*[col(c) if c == key else F.col("r").getField(c).alias(c) for c in fill_columns])
    pieces = cut(collect_pieces(filled.where(col(key).isNotNull()), [key], list_columns, order, block=block))
    # A record has one row per block here, so its window is its number of rows over the block's size.
    before = Window.partitionBy(col(key)).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.select("*", *[
        F.coalesce(F.sum(F.size(col(c))).over(before), F.lit(0)).alias(f"__before{i}") for i, c in enumerate(list_columns)])
    items = []
    for i, c in enumerate(list_columns):
        items.append(placed.select(col(key), F.lit(c).alias("name"), F.col(f"__before{i}").alias("b"), F.posexplode(col(c)).alias(
            "p", "value")).select(col(key), "name", (F.col("b") + F.col("p")).cast("long").alias("at"), "value"))
        none = pieces.groupBy(col(key)).agg(F.sum(F.size(col(c))).alias("n")).where("n = 0")
        items.append(none.select(col(key), F.lit(c).alias("name"), F.lit(0).cast("long").alias("at"), F.lit("").alias("value")))
    return records, reduce(DataFrame.unionAll, items)


def roll_up_text(df: DataFrame, fill_columns: Sequence[str], concat_columns: Sequence[str], keep: Sequence[str],
                 key: str, order: str = ORDER, sep: str = ",", block: int = BLOCK,
                 tokens: Sequence[str] = CONCAT_TOKENS, feedback: Mapping[str, str] | None = None) -> DataFrame:
    """One row per record: columns filled down, some concatenated, the rest from the record's first row.

    `feedback` adds extra aggregates per record, computed in the same grouping.
    """
    filled = null_tokens(fill_down(df, fill_columns, order), tokens)
    joined = [c for c in keep if c in concat_columns]
    plain = [c for c in keep if c not in concat_columns and c != key]
    named = dict(feedback or {})
    first = [F.expr(f"min_by(struct({listed(plain)}), {quoted(order)}) AS __first")] if plain else []
    # A last-wins value travels with its row order so that pieces can be compared.
    extra = [*first, *[F.expr(f"max({text}) AS __x{i}") for i, text in enumerate(named.values())]]
    pieces = _pieces(filled, [key], joined, (), order, block, extra).selectExpr(
        quoted(key), "piece", *(["__first"] if plain else []), *[f"__x{i}" for i in range(len(named))],
        *[f"{_joined(i, sep)} AS v{i}" for i in range(len(joined))])
    grouped = pieces.groupBy(quoted(key)).agg(
        _all_pieces(len(joined)), *([F.expr("min_by(__first, piece) AS __first")] if plain else []),
        *[F.expr(f"max(__x{i}) AS __x{i}") for i in range(len(named))])
    has_key = f"CASE WHEN {quoted(key)} IS NOT NULL THEN {{}} END"
    made = {key: quoted(key), **{c: f"__first.{quoted(c)}" for c in plain}}
    made |= {c: has_key.format(_whole(i, sep)) for i, c in enumerate(joined)}
    made |= {c: has_key.format(f"__x{i}.v") for i, c in enumerate(named)}
    return grouped.selectExpr(*[f"{made[c]} AS {quoted(c)}" for c in [*keep, *named]])


def last_answers(question: str, picks: Mapping[str, tuple[str, str]], order: str = ORDER) -> dict[str, str]:
    """Per output name, SQL for the struct (row order, value) of a row answering the named question, else null.

    `picks` maps an output name to (question text, value column). The greatest order wins, a null value included.
    """
    return {
        out: f"CASE WHEN {quoted(question)} = {text_literal(text)} THEN "
             f"named_struct('o', {quoted(order)}, 'v', {quoted(value)}) END"
        for out, (text, value) in picks.items()
    }


def attach_last_answers(df: DataFrame, key: str, question: str, picks: Mapping[str, tuple[str, str]],
                        order: str = ORDER) -> DataFrame:
    """Every row of a key gets the key's last answer to each question."""
    answers = df.groupBy(col(key)).agg(*[
        F.max_by(col(value), F.when(col(question) == F.lit(text), col(order))).alias(out)
        for out, (text, value) in picks.items()
    ]).where(col(key).isNotNull())
    right = answers.withColumnRenamed(key, "__key")
    return df.join(right, col(key) == F.col("__key"), "left").drop("__key")


def count_report(before: DataFrame, added: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: rows before, rows added, rows after, distinct keys in the source."""
    def tag(df: DataFrame, side: str, value: Column) -> DataFrame:
        return df.select(F.lit(side).alias("side"), value.cast("string").alias("k"))

    none = F.lit(None)
    rows = tag(before, "before", none).unionAll(tag(added, "added", none)).unionAll(tag(source, "source", col(key)))
    per_key = rows.groupBy("side", "k").agg(F.count(F.lit(1)).alias("n"))

    def total(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0).cast("long"))

    return per_key.agg(
        total("before").alias("rows_before"),
        total("added").alias("rows_added"),
        (total("before") + total("added")).alias("rows_after"),
        F.count(F.when(F.col("side") == "source", F.col("k"))).alias("distinct_keys"),
    )
