"""Union, merge, upsert and sync."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.operators import merge
from rollmatch.queries.registry import ORACLES, query
from rollmatch.session import cut, load, scratch_path
from rollmatch.sources.keyed import KeyedTable

# Overlapping sides; some old keys are blank, some new ones null.
# Both sides hold every order; those that are not open have keys of their own on the new side.
OLD_WHERE = NEW_WHERE = "true"
OLD_KEY = "CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN ' ' ELSE CAST(o_orderkey AS STRING) END AS k"
NEW_KEY = """CASE WHEN o_totalprice > 490000 THEN NULL WHEN o_orderstatus <> 'O' THEN concat('n', CAST(o_orderkey AS STRING))
    ELSE CAST(o_orderkey AS STRING) END AS k"""
OLD_COLS = (OLD_KEY, "o_totalprice AS price", "o_orderpriority AS label", "o_orderkey AS ord")
NEW_COLS = (NEW_KEY, "o_totalprice + 1 AS price", "o_custkey AS cust", "o_orderkey AS ord")


def sides(spark, sf):
    orders = load(spark, sf, "orders")
    return orders.where(OLD_WHERE).selectExpr(*OLD_COLS), orders.where(NEW_WHERE).selectExpr(*NEW_COLS)


OLD_SQL = f"SELECT {', '.join(OLD_COLS)} FROM orders WHERE {OLD_WHERE}"
NEW_SQL = f"SELECT {', '.join(NEW_COLS)} FROM orders WHERE {NEW_WHERE}"
MERGED_SQL = f"""SELECT k, price, label, cust, status FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY src DESC, ord DESC) AS rn FROM (
      SELECT k, price, label, NULL AS cust, ord, 0 AS src, 'Old VRF ID' AS status FROM ({OLD_SQL})
      UNION ALL SELECT k, price, NULL, cust, ord, 1, 'New VRF ID' FROM ({NEW_SQL})))
    WHERE rn = 1 AND trim(coalesce(k, '<NA>')) <> ''"""


@query("""SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS balance, 0 AS _src FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal, 1 FROM supplier""")
def d4_stack_tables(spark, sf):
    customer = load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    supplier = load(spark, sf, "supplier").selectExpr("s_acctbal AS balance", "s_name AS name", "s_suppkey AS id")
    return merge.stack_tables([customer, supplier])


@query("""SELECT c_custkey AS id, 0 AS _src FROM customer UNION ALL SELECT s_suppkey, 1 FROM supplier""")
def d5_skip_empty_inputs(spark, sf):
    customer = load(spark, sf, "customer").selectExpr("c_custkey AS id")
    supplier = load(spark, sf, "supplier").selectExpr("s_suppkey AS id")
    return merge.stack_tables(merge.drop_empty([customer, customer.where("id < 0"), supplier]))


@query(MERGED_SQL)
def m1_merge_old_new(spark, sf):
    old, new = sides(spark, sf)
    return merge.merge_old_new(old, new, "status", "Old VRF ID", "New VRF ID", "ord").drop("ord")


MAIN = ("concat(' ', CAST(o_orderkey AS STRING)) AS k", "o_orderstatus AS main_status", "o_totalprice AS price")


@query(f"""WITH g AS (SELECT trim(k) AS k, price, label, cust, status FROM ({MERGED_SQL}))
       SELECT k, price, label, cust, status, NULL AS main_status FROM g
       UNION ALL SELECT trim(k), price, NULL, NULL, NULL, main_status FROM (SELECT {', '.join(MAIN)} FROM orders) m
       WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.k = trim(m.k))""")
def m2_upsert_with_orphans(spark, sf):
    main = load(spark, sf, "orders").selectExpr(*MAIN)
    return merge.upsert_with_orphans(m1_merge_old_new(spark, sf), main, "k")


@query(ORACLES["m2_upsert_with_orphans"])
def m2_upsert_bucketed(spark, sf):
    """The main table lies in buckets of its key and is replaced by a new version, read back."""
    table = KeyedTable(spark, scratch_path(spark, "main"), ["k"], buckets=8)
    table.replace(load(spark, sf, "orders").selectExpr(*MAIN))
    table.upsert(cut(m1_merge_old_new(spark, sf)))
    return table.rows()


PARTS = {
    "new": ("p_name AS request", "p_type AS title", "p_brand AS dept", "p_partkey AS ord"),
    "old": ("p_name AS request", "p_type AS title", "p_size AS size", "p_partkey AS ord"),
    "generic": ("p_type AS title", "concat('all about ', p_type) AS description", "p_partkey AS ord"),
}
WHERE = {"new": "p_size > 20", "old": "p_retailprice < 1000", "generic": "p_brand = 'Brand#1'"}


@query(f"""SELECT request, title, dept, size, description FROM (
       SELECT *, row_number() OVER (PARTITION BY request, title ORDER BY src DESC, ord DESC) AS rn FROM (
         SELECT p_name AS request, p_type AS title, p_brand AS dept, NULL AS size, NULL AS description, p_partkey AS ord,
           0 AS src FROM part WHERE {WHERE['new']}
         UNION ALL SELECT p_name, p_type, NULL, p_size, NULL, p_partkey, 1 FROM part WHERE {WHERE['old']}
         UNION ALL SELECT NULL, p_type, NULL, NULL, concat('all about ', p_type), p_partkey, 2 FROM part
           WHERE {WHERE['generic']}))
       WHERE rn = 1""")
def m3_combine_keep_last(spark, sf):
    part = load(spark, sf, "part")
    tables = [part.where(WHERE[n]).selectExpr(*PARTS[n]) for n in ("new", "old", "generic")]
    return merge.combine_keep_last(merge.drop_empty(tables), ["request", "title"], "ord").drop("ord")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE trim(CAST(o_custkey AS VARCHAR)) NOT IN
       (SELECT trim(concat(' ', CAST(c_custkey AS VARCHAR))) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def j3_new_key_rows(spark, sf):
    known = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr(
        "concat(' ', CAST(c_custkey AS STRING)) AS o_custkey")
    return merge.new_key_rows(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                              known, "o_custkey")


@query("""SELECT DISTINCT kind, note, user_id, event_id FROM (SELECT event_id, user_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS kind, CASE WHEN value >= 10 THEN props END AS note
         FROM events) s
       WHERE NOT EXISTS (SELECT 1 FROM events t WHERE t.value < 15 AND t.user_id = s.user_id
         AND (CASE WHEN t.event_type <> 'error' THEN t.event_type END) IS NOT DISTINCT FROM s.kind
         AND (CASE WHEN t.value >= 10 THEN t.props END) IS NOT DISTINCT FROM s.note)""")
def j4_new_rows(spark, sf):
    rows = load(spark, sf, "events").selectExpr(
        "event_id", "user_id", "value", "CASE WHEN event_type <> 'error' THEN event_type END AS kind",
        "CASE WHEN value >= 10 THEN props END AS note")
    target = rows.where("value < 15").selectExpr("note", "user_id", "kind", "value AS other")
    return merge.new_rows(rows.drop("value"), target)


@query(ORACLES["j3_new_key_rows"])
def j3_new_key_rows_bucketed(spark, sf):
    known = KeyedTable(spark, scratch_path(spark, "known"), ["o_custkey"], buckets=8)
    known.replace(load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr(
        "concat(' ', CAST(c_custkey AS STRING)) AS o_custkey"))
    return known.unseen(load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"))


@query(ORACLES["j4_new_rows"])
def j4_new_rows_bucketed(spark, sf):
    rows = load(spark, sf, "events").selectExpr(
        "event_id", "user_id", "value", "CASE WHEN event_type <> 'error' THEN event_type END AS kind",
        "CASE WHEN value >= 10 THEN props END AS note")
    target = KeyedTable(spark, scratch_path(spark, "rows"), ["kind", "note", "user_id"], buckets=8)
    target.replace(rows.where("value < 15").selectExpr("note", "user_id", "kind", "value AS other"))
    return target.unseen(rows.drop("value"))


@query("""SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS id, '' AS status FROM customer
       WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""")
def j3_sync_aligned(spark, sf):
    target = load(spark, sf, "supplier").selectExpr("s_name AS name", "CAST(s_suppkey AS STRING) AS id", "'x' AS status")
    source = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS name", "c_acctbal")
    return merge.sync_aligned(source, target, "id")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '' AS city FROM customer
       WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def s12_strict_append_rows(spark, sf):
    customer = load(spark, sf, "customer")
    homes = load(spark, sf, "nation").where("n_regionkey = 1")
    held = customer.join(homes, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").selectExpr(
        "concat(' ', CAST(c_custkey AS STRING)) AS ` id `", "c_name AS name")
    source = customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal")
    return merge.strict_append_rows(source, held, ["id", "name", "city"])
