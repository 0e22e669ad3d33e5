"""Enrichment, lookup, outer and containment joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.operators import keywords, lookup
from rollmatch.queries.registry import query
from rollmatch.session import load


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS n_nationkey, c_custkey, coalesce(n_name, '') AS n_name FROM customer
       LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2 UNION ALL SELECT * FROM nation WHERE n_regionkey = 3)
       ON c_nationkey = n_nationkey""")
def j1_enrich(spark, sf):
    nation = load(spark, sf, "nation")
    right = nation.where("n_regionkey <> 2").unionAll(nation.where("n_regionkey = 3"))
    left = load(spark, sf, "customer").selectExpr("c_nationkey AS n_nationkey", "c_custkey")
    return lookup.enrich(left, right, "n_nationkey", ["n_name"], fill="")


@query("""SELECT o_orderkey, o_custkey, total FROM orders LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) AS total
       FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = k""")
def j2_map_values(spark, sf):
    orders = load(spark, sf, "orders")
    best = orders.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("m"))
    return lookup.map_values(orders.select("o_orderkey", "o_custkey"), "o_custkey", best, "m", "total")


# Order counts under shifted customer numbers, so that either side has keys that the other lacks.
@query("""SELECT coalesce(c_custkey, k) AS id, c_name, n FROM customer FULL JOIN (SELECT o_custkey + 7 AS k, count(*) AS n
         FROM orders GROUP BY k) ON c_custkey = k""")
def j5_full_join(spark, sf):
    left = load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name")
    right = load(spark, sf, "orders").groupBy((F.col("o_custkey") + 7).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return lookup.full_join(left, right, "id")


DEPTS = "CASE WHEN p_size < 5 THEN NULL ELSE p_brand END"
TITLES = ("o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE upper(o_orderpriority) END AS t1",
          "CASE o_orderpriority WHEN '1-URGENT' THEN 'PROMO' WHEN '2-HIGH' THEN 'LARGE' ELSE 'SMALL' END AS t2")


@query(f"""WITH d AS (SELECT p_type, {DEPTS} AS dept, min(p_partkey) AS seen FROM part WHERE {DEPTS} IS NOT NULL GROUP BY 1, 2),
       l AS (SELECT p_type, string_agg(dept, ', ' ORDER BY seen) AS depts FROM d GROUP BY p_type),
       r AS (SELECT {', '.join(TITLES)} FROM orders)
       SELECT o_orderkey, t1, t2, CASE WHEN t1 IS NULL THEN 'NA' ELSE concat(t1, ': ', x.depts, ' ') END AS "Department 1",
         CASE WHEN t2 IS NULL THEN 'NA' ELSE concat(t2, ': ', y.depts, ' ') END AS "Department 2"
       FROM r LEFT JOIN l x ON x.p_type = t1 LEFT JOIN l y ON y.p_type = t2""")
def j6_attach_labels(spark, sf):
    jobs = load(spark, sf, "part").selectExpr("p_type", f"{DEPTS} AS dept", "p_partkey AS ord")
    results = load(spark, sf, "orders").selectExpr(*TITLES)
    return lookup.attach_labels(results, jobs, "p_type", "dept", ["t1", "t2"], ["Department 1", "Department 2"], "ord")


@query(f"""WITH d AS (SELECT p_type, {DEPTS} AS dept, min(p_partkey) AS seen FROM part WHERE {DEPTS} IS NOT NULL GROUP BY 1, 2),
       l AS (SELECT p_type, string_agg(dept, ', ' ORDER BY seen) AS depts FROM d GROUP BY p_type),
       r AS (SELECT o_orderkey, 1 AS rank, t1 AS title FROM (SELECT {', '.join(TITLES)} FROM orders)
         UNION ALL SELECT o_orderkey, 2, t2 FROM (SELECT {', '.join(TITLES)} FROM orders))
       SELECT o_orderkey, rank, title, CASE WHEN title IS NULL THEN 'NA' ELSE concat(title, ': ', depts, ' ') END AS department
       FROM r LEFT JOIN l ON p_type = title""")
def j6_attach_label_per_rank(spark, sf):
    """The same over ranked rows: one join, however many ranks there are."""
    jobs = load(spark, sf, "part").selectExpr("p_type", f"{DEPTS} AS dept", "p_partkey AS ord")
    titles = load(spark, sf, "orders").selectExpr(*TITLES)
    ranked = titles.selectExpr("o_orderkey", "stack(2, 1, t1, 2, t2) AS (rank, title)")
    return lookup.attach_label(ranked, jobs, "p_type", "dept", "title", "department", "ord")


FIRST_KEYWORD = """SELECT doc_id, arg_min(b.text, item_id) AS keyword FROM documents d JOIN benchmark b
    ON contains(d.text, b.text) GROUP BY doc_id"""


def _matches(spark, sf):
    return keywords.first_keyword(load(spark, sf, "documents"), "text", load(spark, sf, "benchmark"), "text", "item_id", "doc_id")


@query(FIRST_KEYWORD)
def j7_first_keyword(spark, sf):
    return _matches(spark, sf)


# Besides the passages, a piece of every document: the list grows with the texts, and copies share their pieces.
LONG_LIST = ("SELECT text, item_id FROM benchmark UNION ALL SELECT substr(text, 41, 60), 1000000 + doc_id FROM documents "
             "WHERE length(text) >= 48")


@query(f"""SELECT doc_id, arg_min(b.text, item_id) AS keyword FROM documents d JOIN ({LONG_LIST}) b ON contains(d.text, b.text)
       GROUP BY doc_id""")
def j7_first_keyword_long_list(spark, sf):
    docs = load(spark, sf, "documents")
    listed = load(spark, sf, "benchmark").select("text", "item_id").unionByName(docs.where("length(text) >= 48").selectExpr(
        "substr(text, 41, 60) AS text", "1000000 + doc_id AS item_id"))
    return keywords.first_keyword(docs, "text", listed, "text", "item_id", "doc_id")


@query(f"SELECT DISTINCT keyword FROM ({FIRST_KEYWORD})")
def j7_distinct_keywords(spark, sf):
    return keywords.distinct_keywords(_matches(spark, sf))
