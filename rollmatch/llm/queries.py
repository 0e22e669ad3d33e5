"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from rollmatch.llm.digest_index import DigestIndex, digests, membership
from rollmatch.llm.fingerprints import fingerprints
from rollmatch.llm.hilbert_shards import assign, name_code, size_code
from rollmatch.llm.importance import resample
from rollmatch.llm.language_id import fit as fit_languages, held_out, identify
from rollmatch.llm.line_dedup import dedup_lines
from rollmatch.llm.mixing import plan_mix
from rollmatch.llm.near_dedup import near_groups
from rollmatch.llm.oracles import ORACLES  # noqa: F401
from rollmatch.llm.packing import pack_documents
from rollmatch.llm.pii import find_personal_data
from rollmatch.llm.quality_rules import judge
from rollmatch.llm.source_divergence import audit
from rollmatch.llm.token_alignment import align_tokens
from rollmatch.queries.registry import Query
from rollmatch.session import load, scratch_path

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return find_personal_data(docs, carry=["doc_id"])


@query
def op2_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, carry=["doc_id"]).drop("char_bits", "word_bits")


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target",
                                                   (F.col("copies") * F.col("size")).alias("taken"))


@query
def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = assign(docs, [name_code(F.col("lang")), name_code(F.col("source")), size_code(F.col("size"))],
                    [F.col("doc_id"), F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_groups(docs, carry=["doc_id"])
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    kept = dedup_lines(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    profiles = fit_languages(docs.filter("NOT held_out"))
    return identify(docs, profiles, carry=["doc_id", "held_out"])


@query
def op7_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, load(spark, sf_dir, "labels"), carry=["doc_id"])


@query
def op9_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints(docs, carry=["doc_id"])


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(load(spark, sf_dir, "documents").select("text", "lang", "source"))


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    rows = digests(docs)
    index = DigestIndex(spark, scratch_path(spark, "digests"))
    # Every row is in one of two loads, so that the second meets an index that is filled.
    for part in (0, 1):
        index.add(rows.where(F.col("best.row") % 2 == part))
    return membership(rows, index)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
