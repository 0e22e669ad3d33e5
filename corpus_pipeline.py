"""From raw documents to packed training sequences, stage by stage.

Each stage reads all that the one before it kept, as written to the shared folder, and returns documents again; the last
one returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import quoted
from rollmatch.llm.line_dedup import dedup_lines
from rollmatch.llm.mixing import mix
from rollmatch.llm.near_dedup import keep_one
from rollmatch.llm.packing import pack_documents
from rollmatch.llm.quality_rules import keep_good
from rollmatch.session import cut, load

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stand earlier in the corpus; n_chars follows the text.

    A document that loses its last word with these lines goes; a null text, which has no lines, stays as it is.
    """
    left = dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return left.filter("n_dropped = 0 OR text RLIKE '[^ \\t-\\r]'").select(*[quoted(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing),
    ("packing", packing)]

# The language references, signatures, random rounding and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written and read again."""
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
