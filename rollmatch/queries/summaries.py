"""Text summaries and search texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.functions import text
from rollmatch.operators.rollup import collect_rows
from rollmatch.queries.registry import query
from rollmatch.queries.scalars import END, START
from rollmatch.session import load


@query(f"""WITH j AS (SELECT o_custkey, string_agg(concat('A ', o_orderpriority, ' in the industry doing ', o_orderstatus,
           ' tasks', CASE WHEN o_orderstatus = 'P' THEN '.' ELSE ' for 12 months.' END), ' ' ORDER BY o_orderkey) AS jobs,
         string_agg(concat('''', o_orderpriority, ''''), ', ' ORDER BY o_orderkey) AS quals,
         string_agg(concat('''', o_orderstatus, ''''), ', ' ORDER BY o_orderkey) AS specs,
         string_agg(o_orderstatus, '.' ORDER BY o_orderkey) AS langs FROM orders GROUP BY o_custkey)
       SELECT o_custkey, concat(chr(10), 'Participant ', o_custkey, ' has the following work experience: ', jobs, chr(10),
         'They have the following qualifications: [', quals, '] in [', specs, '].', chr(10),
         'They have the following skills: [', specs, '] and ', c_mktsegment, ' and computer skill ', chr(10), c_name,
         ' and know the following languages: ', langs, '.', chr(10), 'The participant is a ', c_mktsegment, ' and ',
         c_nationkey, ' years old.', chr(10)) AS summary FROM j JOIN customer ON o_custkey = c_custkey""")
def t1_participant_summary(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(
        "o_custkey", "o_orderkey", "o_orderpriority AS industry", "o_orderstatus AS task", f"{START} AS s", f"{END} AS e")
    lists = collect_rows(rows, ["o_custkey"], ["industry", "task", "s", "e"], "o_orderkey")
    both = lists.join(load(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    c = F.col
    return both.select("o_custkey", text.participant_summary(
        c("o_custkey"), c("industry"), c("task"), c("s"), c("e"), c("industry"), c("task"), c("task"),
        c("c_mktsegment"), c("c_name"), c("task"), c("c_mktsegment"), c("c_nationkey").cast("string")).alias("summary"))


@query("""SELECT p_type, concat(chr(10), '    The job titled: "', p_type, '" has a description: ', count(*), ',', chr(10),
         '    and expects the following skills: ', string_agg(p_name, ', ' ORDER BY p_partkey), ', and ',
         string_agg(p_brand, ', ' ORDER BY p_partkey), chr(10), '    and know the languages: ',
         string_agg(p_brand, ', ' ORDER BY p_partkey), '.', chr(10), '    ') AS summary FROM part GROUP BY p_type""")
def t2_specific_job_summary(spark, sf):
    lists = collect_rows(load(spark, sf, "part"), ["p_type"], ["p_name", "p_brand"], "p_partkey")
    c = F.col
    return lists.select("p_type", text.specific_job_summary(
        c("p_type"), F.size("p_name").cast("string"), c("p_name"), c("p_brand"), c("p_brand")).alias("summary"))


@query("""SELECT p_partkey, concat(chr(10), '    The job titled: "', p_name, '" has a description: ', p_type, '.', chr(10),
         '    ') AS summary FROM part""")
def t3_generic_job_summary(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey", text.generic_job_summary(F.col("p_name"), F.col("p_type")).alias("summary"))


def _retrieval(spark, sf, legacy):
    lists = collect_rows(load(spark, sf, "conversations"), ["conv_id"], ["text", "role"], "turn")
    c = F.col
    return lists.select("conv_id", text.retrieval_text(c("conv_id"), c("text"), c("role"), c("text"), legacy).alias("input"))


RETRIEVAL = """WITH l AS (SELECT conv_id, concat(' Participant ', conv_id, ' worked with designations: ',
         string_agg(text, ', ' ORDER BY turn)) AS h, string_agg(concat(' The participant has a ', role,
         ' education specialized in ', text, '. '), '' ORDER BY turn) AS edu FROM conversations GROUP BY conv_id) """


@query(RETRIEVAL + "SELECT conv_id, concat(h, ', ', h, '. ', edu) AS input FROM l")
def t5_retrieval_text(spark, sf):
    return _retrieval(spark, sf, True)


@query(RETRIEVAL + "SELECT conv_id, concat(h, '. ', edu) AS input FROM l")
def t5_retrieval_text_once(spark, sf):
    return _retrieval(spark, sf, False)


@query("""SELECT c_custkey, concat('c_name: ', c_name, chr(10), ' c_nationkey: ', c_nationkey, chr(10), ' c_mktsegment: ',
       coalesce(nullif(c_mktsegment, 'BUILDING'), 'None'), chr(10)) AS text FROM customer""")
def t6_record_text(spark, sf):
    rows = load(spark, sf, "customer").withColumn("c_mktsegment", F.expr("nullif(c_mktsegment, 'BUILDING')"))
    return rows.select("c_custkey", text.record_text(["c_name", "c_nationkey", "c_mktsegment"]).alias("text"))
