"""Fill-down, roll-up, aggregates and row order."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.operators import dedupe, order, rollup
from rollmatch.operators.merge import new_key_rows
from rollmatch.operators.reshape import sort_rows
from rollmatch.queries.registry import query
from rollmatch.session import load

# A multi-row-per-record export drawn from the events: `rec` is present on the first row of a record only.
EXPORT = (
    "event_id AS ord",
    "CASE WHEN event_type = 'view' THEN CAST(user_id AS STRING) WHEN event_type = 'error' THEN '' END AS rec",
    "CASE WHEN event_type IN ('view', 'click') AND value >= 5 THEN event_type WHEN value < 2 THEN '' END AS kind",
    "CASE WHEN value >= 20 THEN props WHEN value < 3 THEN '' END AS note",
    "user_id",
)
EXPORT_SQL = "SELECT " + ", ".join(EXPORT) + " FROM events"


def export(spark, sf):
    return load(spark, sf, "events").selectExpr(*EXPORT)


@query(f"""SELECT ord, user_id, last_value(rec IGNORE NULLS) OVER w AS rec, last_value(kind IGNORE NULLS) OVER w AS kind,
       note FROM ({EXPORT_SQL}) WINDOW w AS (ORDER BY ord)""")
def a1_fill_down_global(spark, sf):
    return order.fill_down(export(spark, sf), ["rec", "kind", "absent"], "ord")


@query(f"""SELECT ord, user_id, rec, last_value(kind IGNORE NULLS) OVER w AS kind, last_value(note IGNORE NULLS) OVER w
       AS note FROM ({EXPORT_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ord)""")
def a2_fill_down_per_key(spark, sf):
    return order.fill_down(export(spark, sf), ["kind", "note"], "ord", within=["user_id"])


FILL_RECORDS_SQL = f"""WITH e AS ({EXPORT_SQL}),
       h AS (SELECT *, max(CASE WHEN rec <> '' THEN ord END) OVER (ORDER BY ord) AS at FROM e)
       SELECT DISTINCT coalesce(nullif(h.rec, ''), p.rec, h.rec) AS rec,
         CASE WHEN h.rec <> '' OR h.at IS NULL THEN h.kind ELSE coalesce(nullif(h.kind, ''), p.kind) END AS kind,
         CASE WHEN h.rec <> '' OR h.at IS NULL THEN h.note ELSE coalesce(nullif(h.note, ''), p.note) END AS note
       FROM h LEFT JOIN e p ON p.ord = h.at"""


@query(FILL_RECORDS_SQL)
def a3_fill_records(spark, sf):
    return rollup.fill_records(export(spark, sf).drop("user_id"), "rec", "ord")


ROW_ABOVE_SQL = f"""WITH e AS ({EXPORT_SQL}) SELECT DISTINCT
       coalesce(last_value(nullif(rec, '') IGNORE NULLS) OVER w, rec) AS rec,
       coalesce(last_value(nullif(kind, '') IGNORE NULLS) OVER w, kind) AS kind,
       coalesce(last_value(nullif(note, '') IGNORE NULLS) OVER w, note) AS note, user_id
       FROM e WINDOW w AS (ORDER BY ord)"""


@query(ROW_ABOVE_SQL)
def a4_fill_from_row_above(spark, sf):
    return rollup.fill_from_row_above(export(spark, sf), "ord")


# The same rows with an order column whose values lie far apart.
GAP = 1_000_003


def sparse(df, name="ord"):
    return df.withColumn(name, F.col(name) * GAP)


def _dense(df, name="ord"):
    return df.withColumn(name, (F.col(name) / GAP).cast("long"))


@query(f"""SELECT ord, user_id, last_value(rec IGNORE NULLS) OVER w AS rec, last_value(kind IGNORE NULLS) OVER w AS kind,
       note FROM ({EXPORT_SQL}) WINDOW w AS (ORDER BY ord)""")
def a1_fill_down_sparse(spark, sf):
    return _dense(order.fill_down(sparse(export(spark, sf)), ["rec", "kind"], "ord"))


@query(f"""SELECT ord, user_id, rec, last_value(kind IGNORE NULLS) OVER w AS kind, last_value(note IGNORE NULLS) OVER w
       AS note FROM ({EXPORT_SQL}) WINDOW w AS (PARTITION BY user_id ORDER BY ord)""")
def a2_fill_down_per_key_sparse(spark, sf):
    return _dense(order.fill_down(sparse(export(spark, sf)), ["kind", "note"], "ord", within=["user_id"]))


@query(FILL_RECORDS_SQL)
def a3_fill_records_sparse(spark, sf):
    return rollup.fill_records(sparse(export(spark, sf)).drop("user_id"), "rec", "ord")


@query(ROW_ABOVE_SQL)
def a4_fill_from_row_above_sparse(spark, sf):
    return rollup.fill_from_row_above(sparse(export(spark, sf)), "ord")


# A third of the rows under one key, in pieces of a thousand places.
HOT = "CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE CAST(user_id AS STRING) END AS k"


def hot(spark, sf):
    return export(spark, sf).selectExpr("ord", HOT, "kind", "note")


@query(f"""SELECT k, ord // 1000 AS piece, string_agg(kind, ',' ORDER BY ord) AS kind, string_agg(note, ',' ORDER BY ord) AS note
       FROM (SELECT ord, {HOT}, kind, note FROM ({EXPORT_SQL})) GROUP BY ALL""")
def a5_concat_pieces(spark, sf):
    return rollup.concat_pieces(hot(spark, sf), ["k"], ["kind", "note"], "ord", block=1000)


@query(f"""SELECT k, ord // 1000 AS piece, coalesce(string_agg(kind, '|' ORDER BY ord), '') AS kind, count(kind) AS n
       FROM (SELECT ord, {HOT}, kind FROM ({EXPORT_SQL})) GROUP BY ALL""")
def a6_collect_pieces(spark, sf):
    lists = rollup.collect_pieces(hot(spark, sf), ["k"], ["kind"], "ord", block=1000)
    return lists.select("k", "piece", F.array_join("kind", "|").alias("kind"), F.size("kind").cast("long").alias("n"))


@query("""SELECT conv_id, coalesce(string_agg(said, ',' ORDER BY turn), '') AS said,
       coalesce(string_agg(role, ',' ORDER BY turn), '') AS role
       FROM (SELECT conv_id, turn, role, CASE WHEN role <> 'system' THEN text END AS said FROM conversations)
       GROUP BY conv_id""")
def a5_concat_rows(spark, sf):
    talk = load(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "role", "CASE role WHEN 'system' THEN 'NA' ELSE text END AS said")
    return rollup.concat_rows(talk, ["conv_id"], ["said", "role"], "turn")


@query(f"""SELECT user_id, coalesce(string_agg(kind, ' | ' ORDER BY ord), '') AS kind,
       coalesce(string_agg(note, ' | ' ORDER BY ord), '') AS note FROM ({EXPORT_SQL}) GROUP BY user_id""")
def a5_concat_events(spark, sf):
    return rollup.concat_rows(export(spark, sf), ["user_id"], ["kind", "note"], "ord", sep=" | ")


@query("""SELECT conv_id, coalesce(string_agg(replace(said, '. ', ' ~ '), ' ~ ' ORDER BY turn), '') AS said,
       CAST(greatest(1, coalesce(sum(len(string_split(said, '. '))), 0)) AS BIGINT) AS n,
       string_agg(role, ' ~ ' ORDER BY turn) AS role
       FROM (SELECT conv_id, turn, role, CASE WHEN role <> 'user' THEN text END AS said FROM conversations)
       GROUP BY conv_id""")
def a6_collect_rows(spark, sf):
    talk = load(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "role", "CASE WHEN role <> 'user' THEN replace(text, '. ', '/-/') END AS said")
    lists = rollup.collect_rows(talk, ["conv_id"], ["said", "role"], "turn")
    return lists.select("conv_id", F.array_join("said", " ~ ").alias("said"), F.size("said").cast("long").alias("n"),
                        F.array_join("role", " ~ ").alias("role"))


KEYED = ("event_id AS ord", "CASE WHEN event_type = 'view' THEN CAST(user_id AS STRING) END AS rec",
         "CASE WHEN event_type IN ('view', 'click') AND value >= 5 THEN event_type END AS kind",
         "CASE WHEN value >= 20 THEN props WHEN value < 3 THEN '' END AS note", "event_type")
KEYED_SQL = "SELECT " + ", ".join(KEYED) + " FROM events"


@query(f"""WITH k AS (SELECT ord, rec, event_type,
         CASE WHEN rec IS NOT NULL THEN coalesce(nullif(kind, ''), 'NA') ELSE kind END AS kind,
         CASE WHEN rec IS NOT NULL THEN coalesce(nullif(note, ''), 'NA') ELSE note END AS note FROM ({KEYED_SQL})),
       f AS (SELECT ord, last_value(rec IGNORE NULLS) OVER w AS rec, last_value(kind IGNORE NULLS) OVER w AS kind,
         note, event_type FROM k WINDOW w AS (ORDER BY ord)),
       n AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY ord) AS rn FROM f)
       SELECT rec, max(CASE WHEN rn = 1 THEN kind END) AS kind,
         CASE WHEN rec IS NOT NULL THEN coalesce(string_agg(note, ' ~ ' ORDER BY ord), '') END AS note,
         CASE WHEN rec IS NOT NULL THEN string_agg(event_type, ' ~ ' ORDER BY ord) END AS event_type
       FROM n GROUP BY rec""")
def a7_roll_up_lists(spark, sf):
    rows = load(spark, sf, "events").selectExpr(*KEYED)
    rolled = rollup.roll_up_lists(rows, ["rec", "kind"], ["note", "event_type"], "rec", "ord")
    return rolled.select("rec", "kind", F.array_join("note", " ~ ").alias("note"),
                         F.array_join("event_type", " ~ ").alias("event_type"))


@query(f"""WITH f AS (SELECT ord, last_value(rec IGNORE NULLS) OVER w AS rec, last_value(kind IGNORE NULLS) OVER w AS kind,
         note, event_type FROM ({KEYED_SQL}) WINDOW w AS (ORDER BY ord)),
       n AS (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY ord) AS rn FROM f)
       SELECT rec, max(CASE WHEN rn = 1 THEN kind END) AS kind, max(CASE WHEN rn = 1 THEN event_type END) AS event_type,
         CASE WHEN rec IS NOT NULL THEN coalesce(string_agg(note, ',' ORDER BY ord), '') END AS note
       FROM n GROUP BY rec""")
def a8_roll_up_text(spark, sf):
    rows = load(spark, sf, "events").selectExpr(*KEYED)
    return rollup.roll_up_text(rows, ["rec", "kind"], ["note"], ["rec", "kind", "event_type", "note"], "rec", "ord")


ANSWERS = ("event_id", "user_id", "event_type", "CASE WHEN value >= 10 THEN props END AS answer")


@query("""WITH a AS (SELECT event_id, user_id, event_type, CASE WHEN value >= 10 THEN props END AS answer FROM events),
       m AS (SELECT user_id, max(event_id) FILTER (event_type = 'view') AS v, max(event_id) FILTER (event_type = 'click')
         AS c FROM a GROUP BY user_id)
       SELECT a.*, x.answer AS view_answer, y.answer AS click_answer FROM a JOIN m USING (user_id)
       LEFT JOIN a x ON x.event_id = m.v LEFT JOIN a y ON y.event_id = m.c""")
def a9_last_answers(spark, sf):
    rows = load(spark, sf, "events").selectExpr(*ANSWERS)
    return rollup.attach_last_answers(
        rows, "user_id", "event_type", {"view_answer": ("view", "answer"), "click_answer": ("click", "answer")},
        "event_id")


@query("""SELECT (SELECT count(*) FROM customer WHERE c_mktsegment = 'BUILDING') AS rows_before,
       (SELECT count(*) FROM customer WHERE c_mktsegment <> 'BUILDING') AS rows_added,
       (SELECT count(*) FROM customer) AS rows_after, (SELECT count(DISTINCT c_nationkey) FROM customer) AS distinct_keys""")
def a10_count_report(spark, sf):
    customer = load(spark, sf, "customer")
    held = customer.where("c_mktsegment = 'BUILDING'")
    return rollup.count_report(held, new_key_rows(customer, held, "c_custkey"), customer, "c_nationkey")


@query("""SELECT max(length(text)) AS longest, (SELECT doc_id FROM documents ORDER BY length(text) DESC, doc_id DESC
       LIMIT 1) AS doc_id FROM documents""")
def a11_max_scalars(spark, sf):
    return load(spark, sf, "documents").agg(
        F.max(F.length("text")).cast("long").alias("longest"),
        F.max_by("doc_id", F.struct(F.length("text"), "doc_id")).alias("doc_id"))


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""")
def d1_keep_first(spark, sf):
    return dedupe.keep_first(load(spark, sf, "events").drop("props"), ["user_id"], "event_id")


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1""")
def d2_keep_last(spark, sf):
    rows = load(spark, sf, "events").drop("props")
    return dedupe.keep_last(rows, ["user_id", "event_type", "absent"], "event_id")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def d3_distinct_rows(spark, sf):
    return dedupe.distinct_rows(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_orderkey")
def l1_sort_rows(spark, sf):
    return sort_rows(load(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"),
                     "o_orderpriority", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20")
def l2_first_rows(spark, sf):
    return order.first_rows(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 20, "o_orderkey")


@query("SELECT l_orderkey, l_extendedprice FROM lineitem ORDER BY l_orderkey * 8 + l_linenumber, l_extendedprice LIMIT (SELECT count(*) // 3 FROM lineitem)")
def l2_first_third(spark, sf):
    """A third of the line items in row order, cut off at a counted value; ties are there to be told apart."""
    items = load(spark, sf, "lineitem").selectExpr("l_orderkey", "l_extendedprice", "l_orderkey * 8 + l_linenumber AS at")
    found = order.lowest_rows(items, items.count() // 3, F.col("at"), F.col("l_extendedprice"), few=0)
    return found.drop("at")


@query("SELECT count(*) // 3 AS n, true AS agree FROM lineitem")
def l3_sample_third(spark, sf):
    """A third of the line items drawn by a key that repeats: exactly that many, and the same ones again."""
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    n = items.count() // 3
    marks = [order.sample_rows(items, n, "l_orderkey", seed=3, few=0).select(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("l_orderkey").cast("decimal(38,0)")).alias("mark")) for _ in (1, 2)]
    return marks[0].crossJoin(marks[1].toDF("m", "other")).select("n", ((F.col("n") == F.col("m")) & (F.col("mark") == F.col("other"))).alias("agree"))


@query("SELECT 20 AS n, 20 AS keys, 20 AS known, true AS agree, true AS other_differs")
def l3_sample_rows(spark, sf):
    """Rows drawn, distinct keys, keys that the table has; whether one seed draws the same again, and another differs."""
    orders = load(spark, sf, "orders").select("o_orderkey")
    first, again, other = (order.sample_rows(orders, 20, "o_orderkey", seed).withColumn(name, F.lit(1))
                           for seed, name in ((7, "a"), (7, "b"), (8, "c")))
    drawn = first.join(again, "o_orderkey", "full").join(other, "o_orderkey", "full")
    known = drawn.join(orders, "o_orderkey", "left_semi")
    counts = known.agg(F.count("a").alias("n"), F.count_distinct(F.when(F.col("a") == 1, F.col("o_orderkey"))).alias("keys"),
                       F.count(F.when(F.col("a") == 1, 1)).alias("known"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("both"),
                       F.count(F.when(F.col("a") == F.col("c"), 1)).alias("shared"))
    return counts.select(*[F.col(c).cast("int").alias(c) for c in ("n", "keys", "known")], (F.col("both") == 20).alias("agree"),
                         (F.col("shared") < 20).alias("other_differs"))


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events")
def l4_row_numbers_sparse(spark, sf):
    events = sparse(load(spark, sf, "events").select("event_id"), "event_id")
    return _dense(order.number_rows(events, "n", "event_id"), "event_id")


@query("""SELECT id, doc_id, n FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id,
       CASE WHEN lang = 'en' THEN 0 ELSE length(text) END AS n FROM documents) WHERE n > 0""")
def l4_row_ids_with_gaps(spark, sf):
    docs = load(spark, sf, "documents").selectExpr(
        "doc_id", "CAST(CASE WHEN lang = 'en' THEN 0 ELSE length(text) END AS BIGINT) AS n")
    return order.number_rows(docs, "id", "doc_id").where("n > 0")


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey FROM orders")
def l4_row_numbers(spark, sf):
    return order.number_rows(load(spark, sf, "orders").select("o_orderkey"), "id", "o_orderkey", start=1)
