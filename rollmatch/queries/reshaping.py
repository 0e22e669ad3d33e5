"""Explode, pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rollmatch.operators import reshape
from rollmatch.operators.rollup import collect_rows
from rollmatch.queries.registry import query
from rollmatch.session import load


@query("SELECT conv_id, role, text FROM conversations")
def r1_explode_paired(spark, sf):
    lists = collect_rows(load(spark, sf, "conversations"), ["conv_id"], ["role", "text"], "turn")
    return reshape.explode_paired(lists, ["role", "text"])


@query("SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS embedding FROM embeddings")
def r2_explode_column(spark, sf):
    return reshape.explode_column(load(spark, sf, "embeddings"), "vec_id", "embedding").select(
        "vec_id", F.col("embedding").cast("double").alias("embedding"))


# The dearest orders of each customer; some customers have fewer than three.
RANKED = """SELECT o_custkey, rank, title, request, score FROM (SELECT o_custkey, o_orderpriority AS title,
    CAST(o_orderkey AS VARCHAR) AS request, o_totalprice AS score,
    CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS rank
    FROM orders) WHERE rank <= 3"""


def ranked(spark, sf):
    done = load(spark, sf, "orders")
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return done.withColumn("rank", F.row_number().over(w)).where("rank <= 3").selectExpr(
        "o_custkey", "rank", "o_orderpriority AS title", "CAST(o_orderkey AS STRING) AS request", "o_totalprice AS score")


def _cells(value, heading, pad):
    return ", ".join(f"""coalesce(max(CASE WHEN rank = {i} THEN {value} END), {pad}) AS "{heading}: {i}" """ for i in (1, 2, 3))


WIDE = f"""SELECT o_custkey, {_cells('title', 'Pred Job Title', "'NA'")}, {_cells('request', 'Pred VRF ID', "'NA'")},
    {_cells('score', 'Score', 'NULL')} FROM ({RANKED}) GROUP BY o_custkey"""


@query(WIDE)
def r3_ranked_to_wide(spark, sf):
    return reshape.ranked_to_wide(
        ranked(spark, sf), "o_custkey", "rank",
        {"title": "Pred Job Title", "request": "Pred VRF ID", "score": "Score"}, 3,
        {"title": "NA", "request": "NA", "score": None})


def _part(i, dept):
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, "Pred Job Title: {i}" AS "Job Title Prediction",
        "Pred VRF ID: {i}" AS "VRF ID", {dept} AS "Department", {i} AS "Rank" FROM ({WIDE})
        WHERE "Pred Job Title: {i}" <> 'NA' """


@query(" UNION ALL ".join([
    _part(1, """concat('d', "Pred VRF ID: 1")"""), _part(2, """ "Pred VRF ID: 2" """), _part(3, """ "Pred VRF ID: 3" """)]))
def r4_wide_to_ranked(spark, sf):
    wide = r3_ranked_to_wide(spark, sf).withColumns({
        "Department 1": F.concat(F.col("`Pred Job Title: 1`"), F.lit(":  d"), F.col("`Pred VRF ID: 1`"), F.lit(": x")),
        "Department 2": F.when(F.col("`Score: 2`") > 0, F.lit("")),
    })
    triples = [(f"Pred Job Title: {i}", f"Pred VRF ID: {i}", f"Department {i}") for i in (1, 2, 3)]
    return reshape.wide_to_ranked(wide, "o_custkey", triples)


@query("""SELECT conv_id, string_agg(role, ', ' ORDER BY turn) AS role, string_agg(text, ', ' ORDER BY turn) AS text
       FROM conversations GROUP BY conv_id""")
def r5_join_lists(spark, sf):
    return reshape.join_lists(collect_rows(load(spark, sf, "conversations"), ["conv_id"], ["role", "text"], "turn"))
