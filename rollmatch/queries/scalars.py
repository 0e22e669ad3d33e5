"""Dates, numbers, list text, rules and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.functions import dates, jsontext, nulls, text
from rollmatch.operators.rollup import collect_rows
from rollmatch.operators.rules import adjust_titles
from rollmatch.queries.registry import query
from rollmatch.session import load

# Date texts of an order: unpadded, padded with a day that may not exist, or no date at all.
DAY = "concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-', CAST(day(o_orderdate) AS STRING))"
START = f"CASE WHEN o_orderstatus = 'P' THEN concat(CAST(year(o_orderdate) AS STRING), '-02-30') ELSE {DAY} END"
END = "concat(CAST(year(o_orderdate) + 1 AS STRING), '-', CAST(month(o_orderdate) AS STRING), '-28')"
START_SQL = f"CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END"
END_SQL = "make_date(year(o_orderdate) + 1, month(o_orderdate), 28)"


@query(f"SELECT o_orderkey, {START_SQL} AS start_day, {END_SQL} AS end_day FROM orders")
def e1_parse_day(spark, sf):
    texts = load(spark, sf, "orders").selectExpr("o_orderkey", f"{START} AS s", f"{END} AS e")
    return texts.select("o_orderkey", dates.parse_day(F.col("s")).alias("start_day"), dates.parse_day(F.col("e")).alias("end_day"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST((year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS BIGINT) AS months
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def e2_month_difference(spark, sf):
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    both = lines.join(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                      F.col("l_orderkey") == F.col("o_orderkey"))
    months = dates.month_difference(F.col("o_orderdate"), F.col("l_shipdate"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", months.cast("long").alias("months"))


# A customer whose oldest order is dear has one end date less; one with urgent orders only has NA among the starts.
def _date_lists(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(
        "o_custkey", "o_orderkey",
        f"CASE WHEN o_totalprice > 499000 THEN 'NA' ELSE {START} END AS s",
        f"CASE WHEN o_totalprice < 2000 THEN NULL ELSE {END} END AS e")
    return collect_rows(rows, ["o_custkey"], ["s", "e"], "o_orderkey")


LISTS_SQL = """SELECT o_custkey,
    count(*) FILTER (o_totalprice < 2000) > 0 OR count(*) FILTER (o_totalprice > 499000) > 0 AS broken"""


@query(f"""{LISTS_SQL},
       CASE WHEN NOT (count(*) FILTER (o_totalprice < 2000) > 0 OR count(*) FILTER (o_totalprice > 499000) > 0)
         THEN string_agg(CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE
           CAST(round(date_diff('day', {START_SQL}, {END_SQL}) / 365.0::DOUBLE, 2) AS VARCHAR) END, ',' ORDER BY o_orderkey)
         END AS years FROM orders GROUP BY o_custkey""")
def e3_years_between(spark, sf):
    lists = _date_lists(spark, sf)
    years = dates.years_between_lists(F.col("s"), F.col("e"))
    return lists.select("o_custkey", years.isNull().alias("broken"), F.array_join(
        F.transform(years, lambda y: y.cast("string")), ",", "null").alias("years"))


@query(f"""{LISTS_SQL},
       CASE WHEN count(*) FILTER (o_totalprice < 2000) > 0 OR count(*) FILTER (o_totalprice > 499000) > 0 THEN 'NA'
         ELSE string_agg({START}, ',' ORDER BY o_orderkey) END AS starts,
       CASE WHEN count(*) FILTER (o_totalprice < 2000) > 0 OR count(*) FILTER (o_totalprice > 499000) > 0 THEN 'NA'
         ELSE string_agg({END}, ',' ORDER BY o_orderkey) END AS ends FROM orders GROUP BY o_custkey""")
def e4_repair_date_lists(spark, sf):
    starts, ends = dates.repair_date_lists(F.col("s"), F.col("e"))
    return _date_lists(spark, sf).select(
        "o_custkey", (starts == F.array(F.lit("NA"))).alias("broken"),
        F.array_join(starts, ",").alias("starts"), F.array_join(ends, ",").alias("ends"))


@query("""SELECT event_id, coalesce(TRY_CAST(amount AS DOUBLE), 0) AS amount FROM (SELECT event_id, CASE event_type
       WHEN 'error' THEN props WHEN 'view' THEN NULL ELSE CAST(value AS VARCHAR) END AS amount FROM events)""")
def e6_number_or_zero(spark, sf):
    texts = load(spark, sf, "events").selectExpr("event_id", """CASE event_type WHEN 'error' THEN props
        WHEN 'view' THEN NULL ELSE CAST(value AS STRING) END AS amount""")
    return texts.select("event_id", nulls.number_or_zero(F.col("amount")).alias("amount"))


DEPT = """CASE p_type WHEN 'PROMO' THEN NULL WHEN 'SMALL' THEN '' WHEN 'LARGE' THEN p_brand WHEN 'MEDIUM' THEN 'nan'
    ELSE concat(p_type, ':  ', p_brand, ' : ', p_name) END AS dept"""


@query(f"""SELECT p_partkey, CASE WHEN coalesce(dept, '') IN ('', 'nan') THEN 'NA'
       WHEN contains(dept, ':') THEN trim(split_part(dept, ':', 2)) ELSE dept END AS label
       FROM (SELECT p_partkey, {DEPT} FROM part)""")
def e7_department_label(spark, sf):
    part = load(spark, sf, "part").selectExpr("p_partkey", DEPT)
    return part.select("p_partkey", text.department_label(F.col("dept")).alias("label"))


@query("""SELECT conv_id, concat('[', string_agg(CASE WHEN role = 'user' THEN concat('"it''s ', role, '"')
         ELSE concat('''', role, '''') END, ', ' ORDER BY turn), ']') AS roles,
       count(*) = 1 AND max(role) = 'NA' AS nothing
       FROM (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'NA' ELSE role END AS role FROM conversations)
       GROUP BY conv_id""")
def e8_list_repr(spark, sf):
    talk = load(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "CASE role WHEN 'system' THEN 'NA' WHEN 'user' THEN concat('it\\'s ', role) ELSE role END AS role")
    shown = collect_rows(talk, ["conv_id"], ["role"], "turn").select("conv_id", text.list_repr(F.col("role")).alias("roles"))
    return shown.withColumn("nothing", text.is_na_list(F.col("roles")))


RULE = (
    "o_orderkey", "CASE WHEN o_orderstatus = 'F' THEN 'Researcher' WHEN o_orderstatus = 'O' THEN 'Cook' END AS title",
    "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '[\\'NA\\']' ELSE '[\\'Clerk\\']' END AS work",
    "CASE WHEN o_totalprice > 200000 THEN ' [\\'NA\\']' ELSE '[\\'BSc\\']' END AS qual",
    "CASE WHEN o_totalprice > 300000 THEN '[\\'NA\\'] ' END AS spec",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(year(o_orderdate) + 25 AS STRING) ELSE 'unknown' END AS year",
)


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'Cook' WHEN o_orderstatus = 'P' THEN NULL
         WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN 'Researcher'
         WHEN o_totalprice > 300000 THEN 'Ashram Support'
         WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) + 25 IN (2023, 2024, 2025) THEN 'Fresher'
         ELSE 'Ashram Support' END AS title FROM orders""")
def e9_adjust_titles(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(*RULE)
    return adjust_titles(rows, "title", "work", "qual", "spec", "year").select("o_orderkey", "title")


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment AS segment, true AS has_segment FROM customer")
def e10_row_json(spark, sf):
    customer = load(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "c_acctbal", "nullif(c_mktsegment, 'BUILDING') AS segment", "c_mktsegment")
    record = jsontext.row_json(["c_custkey", "c_name", "c_acctbal", "segment"])
    back = customer.select("c_mktsegment", record.alias("r"))
    return back.select(
        F.get_json_object("r", "$.c_custkey").cast("long").alias("c_custkey"), F.get_json_object("r", "$.c_name").alias("c_name"),
        F.get_json_object("r", "$.c_acctbal").cast("double").alias("c_acctbal"),
        F.coalesce(F.get_json_object("r", "$.segment"), F.when(F.col("c_mktsegment") == "BUILDING", "BUILDING")).alias("segment"),
        F.contains(F.col("r"), F.lit('"segment":')).alias("has_segment"))


REPLY = """CASE event_type WHEN 'view' THEN concat('Sure: ', props, ' Bye.') WHEN 'click' THEN 'no braces'
    WHEN 'error' THEN NULL WHEN 'signup' THEN concat('{"k": ', props, '}') ELSE concat(props, ' or ', props) END AS reply"""


@query("""SELECT event_id, CASE event_type WHEN 'view' THEN json_extract_string(props, '$.k')
         WHEN 'signup' THEN props END AS k, CASE WHEN event_type IN ('view', 'signup') THEN 1 ELSE 0 END AS n FROM events""")
def e11_json_object(spark, sf):
    rows = load(spark, sf, "events").selectExpr("event_id", REPLY)
    tags = rows.select("event_id", jsontext.json_object(F.col("reply")).alias("t"))
    # A nested value keeps its JSON text; spacing inside it does not count.
    return tags.select("event_id", F.regexp_replace(F.col("t")["k"], '":(?=\\d)', '": ').alias("k"),
                       F.size("t").alias("n"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'Processing failed'
         WHEN event_type = 'view' THEN json_extract_string(props, '$.k') WHEN event_type = 'signup' THEN props
         ELSE 'No info found' END AS k,
       CASE WHEN event_type = 'error' THEN 'Processing failed' ELSE 'No info found' END AS absent FROM events""")
def e12_tag_value(spark, sf):
    rows = load(spark, sf, "events").selectExpr("event_id", REPLY)
    parsed = rows.withColumn("t", jsontext.json_object(F.col("reply")))
    k = jsontext.tag_value(F.col("t"), "k", F.col("reply"))
    return parsed.select("event_id", F.regexp_replace(k, '":(?=\\d)', '": ').alias("k"),
                         jsontext.tag_value(F.col("t"), "absent", F.col("reply")).alias("absent"))


@query("""SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment END AS name FROM customer""")
def e12_first_filled(spark, sf):
    rows = load(spark, sf, "customer").selectExpr(
        "c_custkey", "c_name", "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS first")
    return rows.select("c_custkey", jsontext.first_filled(F.col("first"), F.col("c_name")).alias("name"))
