"""Selection, schema, null handling and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.functions.nulls import fill_constant, fill_keyed_rows, is_valid_label, null_tokens
from rollmatch.functions.text import newline_cells, newlines_to_spaces
from rollmatch.operators import schema as S
from rollmatch.operators.merge import drop_blank_keys, new_key_rows
from rollmatch.operators.rollup import collect_rows
from rollmatch.queries.registry import query
from rollmatch.session import load


@query("SELECT p_partkey, p_brand, p_name FROM part")
def p1_select_columns(spark, sf):
    return S.select_exact(load(spark, sf, "part"), ["p_partkey", "p_brand", "p_name"])


@query("""SELECT p_name, p_brand, p_partkey, '' AS "Skills", '' AS "Languages" FROM part""")
def p2_select_preferred(spark, sf):
    return S.select_preferred(
        load(spark, sf, "part"), ["p_name", "Job Title", "p_brand", "p_partkey"], ["p_brand", "Skills", "Languages"])


@query("""SELECT s_suppkey AS c_custkey, s_name AS c_name, '' AS c_nationkey, s_acctbal AS c_acctbal,
       '' AS c_mktsegment FROM supplier""")
def p3_align_schema(spark, sf):
    source = load(spark, sf, "supplier").withColumnsRenamed(
        {"s_suppkey": "c_custkey", "s_name": "c_name", "s_acctbal": "c_acctbal"})
    return S.align_schema(source, load(spark, sf, "customer").columns)


@query("SELECT c_custkey, c_acctbal FROM customer")
def p4_common_columns(spark, sf):
    other = load(spark, sf, "supplier").withColumnsRenamed({"s_acctbal": "c_acctbal", "s_suppkey": "c_custkey"})
    customer = load(spark, sf, "customer")
    return S.select_exact(customer, S.common_columns(customer, other))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate
       FROM lineitem""")
def p5_drop_columns(spark, sf):
    return S.drop_columns(load(spark, sf, "lineitem"), ["l_tax", "l_discount", "l_linestatus", "not there"])


@query("""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus, o_orderpriority FROM orders""")
def p6_move_column(spark, sf):
    moved = S.move_column(load(spark, sf, "orders"), "o_orderstatus", before="o_orderpriority")
    return S.move_column(moved, "o_totalprice", after="o_custkey")


@query("""SELECT o_orderkey, o_totalprice, 'Old VRF ID' AS "VRF ID Status" FROM orders""")
def p7_tag_column(spark, sf):
    return S.tag_column(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "VRF ID Status", "Old VRF ID")


@query("SELECT doc_id, lang, source FROM documents")
def p8_required_columns(spark, sf):
    return S.require(load(spark, sf, "documents"), ["doc_id", "text", "lang"]).select("doc_id", "lang", "source")


@query("""SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       CAST(l_quantity AS VARCHAR) AS l_quantity, l_returnflag, l_extendedprice FROM lineitem""")
def p9_to_text(spark, sf):
    narrow = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_extendedprice")
    return S.to_text(narrow, ["l_orderkey", "l_linenumber", "l_quantity", "absent"])


PADDED = "concat('  ', CAST(c_custkey AS STRING), ' ') AS k"


@query("SELECT trim(concat('  ', CAST(c_custkey AS VARCHAR), ' ')) AS k, c_name FROM customer")
def p10_normalise_key(spark, sf):
    return S.normalise_key(load(spark, sf, "customer").selectExpr(PADDED, "c_name"), "k")


@query("SELECT event_id, user_id FROM events")
def p11_key_to_integer(spark, sf):
    text = load(spark, sf, "events").selectExpr("event_id", "CAST(user_id AS STRING) AS user_id")
    return S.key_to_integer(text, "user_id")


TOKENS = ("event_id", """CASE event_type WHEN 'error' THEN 'nan' WHEN 'view' THEN '' ELSE event_type END AS kind""",
          """CASE WHEN value < 5 THEN 'nan' ELSE props END AS props""")


@query("""SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS kind,
       CASE WHEN value >= 5 THEN props END AS props FROM events""")
def p12_null_tokens(spark, sf):
    return null_tokens(load(spark, sf, "events").selectExpr(*TOKENS))


GAPS = ("event_id", "CASE WHEN event_type = 'view' THEN user_id END AS rec",
        "CASE WHEN event_type <> 'error' THEN event_type END AS kind",
        "CASE WHEN value < 5 THEN '' WHEN value >= 20 THEN props END AS note",
        "CASE WHEN value >= 10 THEN value END AS amount")
GAPS_SQL = "SELECT " + ", ".join(GAPS).replace("AS STRING", "AS VARCHAR") + " FROM events"


@query(f"""SELECT event_id, rec, coalesce(kind, 'NA') AS kind, coalesce(note, 'NA') AS note,
       coalesce(amount, 0) AS amount FROM ({GAPS_SQL})""")
def p13_fill_constant(spark, sf):
    gaps = load(spark, sf, "events").selectExpr(*GAPS)
    return fill_constant(fill_constant(gaps, "NA", only=["kind", "note"]), 0, only=["amount"])


@query(f"""SELECT event_id, rec, amount,
       CASE WHEN rec IS NOT NULL THEN coalesce(nullif(kind, ''), 'NA') ELSE kind END AS kind,
       CASE WHEN rec IS NOT NULL THEN coalesce(nullif(note, ''), 'NA') ELSE note END AS note FROM ({GAPS_SQL})""")
def p14_fill_keyed_rows(spark, sf):
    return fill_keyed_rows(load(spark, sf, "events").selectExpr(*GAPS), "rec", only=["kind", "note"])


@query(r"""SELECT doc_id, CASE WHEN cell = chr(10) THEN ' ' ELSE cell END AS cell, replace(text, chr(10), ' ') AS flat
       FROM (SELECT doc_id, text, CASE WHEN lang = 'en' THEN chr(10) ELSE text END AS cell FROM documents)""")
def p15_newlines(spark, sf):
    docs = load(spark, sf, "documents").withColumn("cell", F.when(F.col("lang") == "en", "\n").otherwise(F.col("text")))
    return docs.select("doc_id", newline_cells(F.col("cell")).alias("cell"), newlines_to_spaces(F.col("text")).alias("flat"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def f1_membership(spark, sf):
    return load(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select(
        "o_orderkey", "o_orderpriority")


@query("""SELECT c_custkey, c_name FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN
       (SELECT trim(CAST(o_custkey AS VARCHAR)) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000)""")
def f2_not_in_keys(spark, sf):
    dear = load(spark, sf, "orders").where("o_orderstatus = 'F' AND o_totalprice > 300000")
    return new_key_rows(load(spark, sf, "customer").select("c_custkey", "c_name"), dear, "c_custkey", "o_custkey")


@query(f"SELECT * FROM ({GAPS_SQL}) WHERE kind IS NOT NULL AND note IS NOT NULL")
def f3_drop_null_rows(spark, sf):
    return load(spark, sf, "events").selectExpr(*GAPS).na.drop(subset=["kind", "note"])


@query(f"SELECT event_id, note FROM ({GAPS_SQL}) WHERE trim(coalesce(note, '<NA>')) <> ''")
def f4_non_blank_key(spark, sf):
    return drop_blank_keys(load(spark, sf, "events").selectExpr(*GAPS), "note").select("event_id", "note")


@query("""SELECT event_id, kind FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'NA' WHEN 'view' THEN ''
       WHEN 'click' THEN NULL ELSE event_type END AS kind FROM events) WHERE kind NOT IN ('NA', '')""")
def f5_valid_label(spark, sf):
    kinds = load(spark, sf, "events").selectExpr("event_id", """CASE event_type WHEN 'error' THEN 'NA' WHEN 'view' THEN ''
        WHEN 'click' THEN NULL ELSE event_type END AS kind""")
    return kinds.where(is_valid_label(F.col("kind")))


@query("""SELECT doc_id, length(body) AS n FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN '' ELSE text END AS body
       FROM documents) WHERE length(body) > 0""")
def f6_non_empty_text(spark, sf):
    docs = load(spark, sf, "documents").selectExpr("doc_id", "CASE WHEN lang = 'en' THEN '' ELSE text END AS body")
    return docs.where(F.length("body") > 0).select("doc_id", F.length("body").cast("long").alias("n"))


@query("""SELECT conv_id, bool_and(role <> 'user') AS nothing FROM conversations GROUP BY conv_id""")
def f7_all_missing(spark, sf):
    talk = load(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "CASE WHEN role <> 'user' THEN 'NA' ELSE role END AS role")
    lists = collect_rows(talk, ["conv_id"], ["role"], "turn")
    return lists.select("conv_id", F.forall("role", lambda r: r == "NA").alias("nothing"))
