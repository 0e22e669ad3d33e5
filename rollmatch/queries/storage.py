"""Sources, sinks and the SQL surface: every query writes whole tables to the shared folder and reads them back."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollmatch.operators import merge
from rollmatch.queries.registry import query
from rollmatch.session import cut, load, scratch_path
from rollmatch.sources import appendlog, logs, sinks, sqltables, tabs, versions

# Document cells hold commas, quotes and line breaks.
CELLS = ("doc_id", "CASE lang WHEN 'en' THEN 'nan' WHEN 'fr' THEN NULL ELSE lang END AS lang", "text")
CELLS_SQL = """CASE WHEN lang NOT IN ('en', 'fr') THEN lang END AS lang"""


@query(f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS _ord, CAST(doc_id AS VARCHAR) AS doc_id, {CELLS_SQL}, text
       FROM documents""")
def s1_read_tab(spark, sf):
    path = scratch_path(spark, "tab")
    sinks.write_tab(load(spark, sf, "documents").selectExpr(*CELLS, "doc_id AS at"), path, order="at")
    return tabs.read_tab(spark, path)


@query("""SELECT row_number() OVER (ORDER BY event_id) - 1 AS _ord, event_id, CASE WHEN event_type <> 'error' THEN value END
       AS value, CASE WHEN event_type <> 'click' THEN event_type END AS event_type FROM events""")
def s2_read_csv(spark, sf):
    path = scratch_path(spark, "csv")
    rows = load(spark, sf, "events").selectExpr(
        "event_id", "CASE event_type WHEN 'error' THEN 'oops' ELSE CAST(value AS STRING) END AS value",
        "CASE event_type WHEN 'click' THEN 'N/A' ELSE event_type END AS event_type")
    sinks.write_csv(rows.withColumn("at", F.col("event_id")), [path], order="at")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()),
                           T.StructField("event_type", T.StringType())])
    return tabs.read_csv(spark, path, schema, multi_line=False, order="_ord")


@query("SELECT c_custkey AS id, c_name AS name FROM customer")
def s3_optional_source(spark, sf):
    path = scratch_path(spark, "optional")
    sinks.write_csv(load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name"), [path])
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    there, missing = (tabs.read_optional(spark, p, schema) for p in (path, path + "-missing"))
    return there.unionByName(missing)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment
       FROM customer""")
def s4_overwrite_tab(spark, sf):
    path = scratch_path(spark, "overwrite")
    rows = load(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "nullif(c_mktsegment, 'BUILDING') AS segment")
    sinks.write_tab(load(spark, sf, "supplier"), path)
    sinks.write_tab(rows, path)
    # Read raw: only a cell without quotes would be null.
    return spark.read.options(**tabs.CSV_OPTIONS, multiLine="true", nullValue="\0").csv(versions.current_path(spark, path))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, concat(c_name, '!') AS name, CASE WHEN c_nationkey > 2 THEN 'far' END AS note
       FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def s4_overwrite_the_tab_it_reads(spark, sf):
    """A tab is replaced twice by what is read from it; in between a write fails and leaves it as it was."""
    path = scratch_path(spark, "itself")
    sinks.write_tab(load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment", "c_nationkey"), path)
    sinks.write_tab(tabs.read_tab(spark, path, order=None).where("c_mktsegment <> 'BUILDING'"), path)
    now = tabs.read_tab(spark, path, order=None)
    try:
        sinks.write_tab(now.selectExpr("id", "raise_error('stopped midway') AS name"), path)
    except Exception as stopped:  # noqa: BLE001
        if "stopped midway" not in str(stopped):
            raise
    now = tabs.read_tab(spark, path, order=None)
    sinks.write_tab(now.selectExpr("id", "concat(name, '!') AS name", "CASE WHEN CAST(c_nationkey AS INT) > 2 THEN 'far' END AS note"), path)
    return tabs.read_tab(spark, path, order=None)


@query("""SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def s5_append_by_position(spark, sf):
    path = scratch_path(spark, "append")
    sinks.append_rows(load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance"), path)
    supplier = load(spark, sf, "supplier")
    sinks.append_rows(supplier.select("s_suppkey", "s_name", "s_acctbal"), path)
    sinks.append_rows(supplier.selectExpr("s_name AS name", "s_suppkey AS other").select("other", "name"), path)
    return appendlog.read_appended(spark, path)


@query("""SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT o_custkey, min(o_orderstatus) FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY o_custkey
       UNION ALL SELECT s_suppkey + 1000000, s_name FROM supplier""")
def s5_append_once(spark, sf):
    """Batches sent twice, and two batches of overlapping keys that were worked out against one state of the table."""
    log = appendlog.AppendLog(spark, scratch_path(spark, "once"))
    people = load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name")
    more = load(spark, sf, "supplier").selectExpr("s_suppkey + 1000000 AS id", "s_name AS name")
    payers = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.min("o_orderstatus").alias("name"))
    for _ in (1, 2):
        log.append(lambda table: people.where("id % 2 = 0"), "even")

    def both(table):
        # While this batch is worked out, another writer adds all people and suppliers.
        log.append(lambda now: merge.new_key_rows(people, now, "id").unionByName(more), "rest")
        return merge.new_key_rows(people.unionByName(payers).dropDuplicates(["id"]), table, "id")

    log.append(both, "overlapping")
    return log.read()


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def s6_replace_table(spark, sf):
    base = scratch_path(spark, "replace")
    sinks.replace_table(load(spark, sf, "orders"), base)
    current = sinks.read_table(spark, base)
    sinks.replace_table(current.where("o_orderstatus <> 'P'").selectExpr("o_orderkey", "o_totalprice + 1 AS o_totalprice"), base)
    return sinks.read_table(spark, base)


@query("SELECT p_partkey, p_name, p_retailprice FROM part UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part")
def s7_write_csv(spark, sf):
    base = scratch_path(spark, "targets")
    paths = [f"{base}/a", f"{base}/b"]
    sinks.write_csv(load(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), paths)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                           T.StructField("p_retailprice", T.DoubleType())])
    one, two = (tabs.read_csv(spark, p, schema) for p in paths)
    return one.unionAll(two)


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def s8_save_sql_table(spark, sf):
    name = f"saved_orders_{uuid.uuid4().hex}"
    path = scratch_path(spark, "sql")
    sqltables.save_sql_table(load(spark, sf, "orders"), name, path)
    counted = cut(sqltables.run_sql(spark, f"SELECT o_orderstatus, count(*) AS n FROM {name} GROUP BY o_orderstatus"))
    spark.sql(f"DROP TABLE {name}")
    return counted


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def s9_write_snapshot(spark, sf):
    base = scratch_path(spark, "snapshots")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for day, status in ((3, "F"), (5, "O"), (4, "P")):
        sinks.write_snapshot(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), base,
                             at=datetime(2024, 1, day, 12, 30, 0))
    return sinks.read_snapshot(spark, base)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s10_read_version(spark, sf):
    base = scratch_path(spark, "versions")
    orders = load(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    for day, status in ((3, "F"), (4, "P"), (5, "O")):
        sinks.write_snapshot(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), base, sinks.INDEX_PREFIX,
                             at=datetime(2024, 1, day, 12, 30, 0))
    return sinks.read_snapshot(spark, base, sinks.INDEX_PREFIX, "20240103_123000")


# A run per year, numbered from 8 on so that their numbers do not sort as texts; urgent orders are in no run.
RUN = "CASE WHEN o_orderpriority <> '1-URGENT' THEN {year} - min({year}) OVER () + 8 END AS run"


@query(f"""WITH r AS (SELECT o_orderkey, o_totalprice, {RUN.format(year='year(o_orderdate)')} FROM orders)
       SELECT o_orderkey, o_totalprice, run FROM r WHERE run = (SELECT max(run) FROM r)""")
def s10_read_latest_run(spark, sf):
    path = scratch_path(spark, "runs")
    orders = load(spark, sf, "orders")
    first = orders.agg(F.min(F.year("o_orderdate"))).first()[0]
    run = F.when(F.col("o_orderpriority") != "1-URGENT", F.year("o_orderdate") - first + 8)
    sinks.write_run_table(orders.select("o_orderkey", "o_totalprice", run.alias("run")), path, "run")
    return sinks.read_latest_run(spark, path, "run")


@query("""SELECT o_orderkey, concat('to: ', o_orderpriority, ' /') AS run FROM orders WHERE o_orderpriority = '5-LOW'""")
def s10_read_latest_escaped_run(spark, sf):
    path = scratch_path(spark, "escaped")
    run = F.concat(F.lit("to: "), F.col("o_orderpriority"), F.lit(" /"))
    sinks.write_run_table(load(spark, sf, "orders").select("o_orderkey", run.alias("run")), path, "run")
    return sinks.read_latest_run(spark, path, "run")


@query("SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings")
def s11_write_vectors(spark, sf):
    base = scratch_path(spark, "vectors")
    rows = load(spark, sf, "embeddings")
    sinks.write_vectors(rows.where("label > 4"), base)
    sinks.write_vectors(rows, base)
    items = sinks.read_table(spark, base).select("vec_id", "label", F.explode("embedding").alias("x"))
    return items.withColumn("x", F.col("x").cast("double"))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '' AS city FROM customer""")
def s12_strict_append(spark, sf):
    path = scratch_path(spark, "strict")
    customer = load(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal", "c_mktsegment")
    sinks.strict_append(customer.where("c_mktsegment = 'BUILDING'"), path, ["id", "name", "city"])
    for _ in (1, 2):
        sinks.strict_append(customer, path, ["id", "name", "city"], batch="all")
    return appendlog.read_appended(spark, path)


@query("""SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS dearest FROM orders WHERE o_totalprice > 100000
       GROUP BY o_orderpriority ORDER BY n DESC LIMIT 3""")
def x1_run_sql(spark, sf):
    sqltables.publish_view(load(spark, sf, "orders"), "orders_view")
    return sqltables.run_sql(
        spark, """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS dearest FROM orders_view
        WHERE o_totalprice > :low GROUP BY o_orderpriority ORDER BY n DESC LIMIT 3""", {"low": 100000})


@query("SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_partkey ORDER BY quantity DESC, l_partkey LIMIT 10")
def l5_sql_limit(spark, sf):
    sqltables.publish_view(load(spark, sf, "lineitem"), "lineitem_view")
    return sqltables.run_sql(spark, """SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem_view GROUP BY l_partkey
        ORDER BY quantity DESC, l_partkey LIMIT 10""")


@query("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderpriority = '5-LOW'")
def l6_latest_by_name(spark, sf):
    path = scratch_path(spark, "named")
    sinks.write_run_table(load(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), path,
                          "o_orderpriority")
    return sinks.read_latest_run(spark, path, "o_orderpriority")


@query("""SELECT c_custkey AS record, 0 AS position, 'c_custkey' AS name, CAST(c_custkey AS VARCHAR) AS value FROM customer
       UNION ALL SELECT c_custkey, 1, 'c_name', c_name FROM customer
       UNION ALL SELECT c_custkey, 2, 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
       UNION ALL SELECT c_custkey, 3, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer
       UNION ALL SELECT c_custkey, 4, 'c_mktsegment', c_mktsegment FROM customer""")
def x2_cells_by_column_listing(spark, sf):
    sqltables.publish_view(load(spark, sf, "customer"), "customer_view")
    return sqltables.cells(spark, "customer_view", "c_custkey")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def x3_records(spark, sf):
    sqltables.publish_view(load(spark, sf, "customer"), "customer_view")
    back = F.from_json("record", "c_custkey bigint, c_name string, c_acctbal double")
    return sqltables.records(spark, "customer_view").select(back.alias("r")).select("r.*")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
       h AS (SELECT doc_id, min(n) FILTER (contains(lower(line), 'ation') OR contains(lower(line), 'ering')) AS n FROM l
         GROUP BY doc_id)
       SELECT h.doc_id, h.n IS NOT NULL AS has_error, trim(line, ' ' || chr(9) || chr(13)) AS first_line
       FROM h LEFT JOIN l ON l.doc_id = h.doc_id AND l.n = h.n""")
def x5_first_trouble(spark, sf):
    lines = load(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return logs.first_trouble(lines, "doc_id", "line_no", "line", words=("ation", "ering"))
