"""End-to-end jobs over exports drawn from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollmatch.functions.columns import col, quoted
from rollmatch.functions.text import list_repr
from rollmatch.operators.dedupe import keep_first
from rollmatch.operators.order import ORDER, fill_down
from rollmatch.operators.vectors import embed_text
from rollmatch.plans import allocation, database, participants, requests, sync, tags
from rollmatch.plans import layouts as L
from rollmatch.queries.matching import NODES, VECTORS, job_nodes
from rollmatch.queries.registry import ORACLES, query
from rollmatch.queries.scalars import REPLY
from rollmatch.session import load, scratch_path
from rollmatch.sources.appendlog import read_appended
from rollmatch.sources.sinks import append_rows, read_snapshot, write_snapshot
from rollmatch.sources.sqltables import run_sql

CENTER, ANSWERS = "Center", ("Answer 1", "Answer 2")
ROLLED, FILLED = L.rolled_columns(CENTER, ANSWERS), L.filled_columns(CENTER)


def dq(name):
    return '"' + name.replace('"', '""') + '"'


def _cell(i, name):
    """Cell text of an export column: gaps, and a word that means missing, at places that differ by column."""
    fixed = {
        "SP ID": "CASE WHEN event_type = 'view' THEN CAST(user_id AS STRING) END",
        "Gender": "CASE WHEN value >= 20 THEN event_type END",
        "Age": "CASE WHEN value >= 30 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) END",
        L.QUESTION: "CASE event_type WHEN 'click' THEN 'Work Experience' WHEN 'signup' THEN 'Education (Red Flags)' END",
        L.SUMMARY: "CASE WHEN value >= 10 THEN props END",
        L.COMMENTS: "CASE WHEN value >= 40 THEN props WHEN value >= 20 THEN event_type END",
        L.GRADUATION: "CASE WHEN value >= 6 THEN CAST(2021 + CAST(floor(least(value / 10, 4)) AS INT) AS STRING) END",
    }
    return fixed.get(name, f"CASE WHEN value >= {i} THEN concat(event_type, ' {i}') WHEN value < 1 THEN 'NA' END")


EXPORT_COLUMNS = list(dict.fromkeys([*ROLLED, *FILLED]))
EXPORT = [(c, _cell(i, c)) for i, c in enumerate(EXPORT_COLUMNS)]


def export(spark, sf, in_order=False):
    """The export's rows; in row order on request, for which the events are sorted before they become wide rows."""
    events = load(spark, sf, "events")
    return (events.orderBy("event_id") if in_order else events).selectExpr(
        f"event_id AS {ORDER}", *[f"{expr} AS {quoted(name)}" for name, expr in EXPORT])


def _fill_sql(columns, fill, source):
    over = "OVER (ORDER BY _ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"SELECT _ord, " + ", ".join(
        f"last_value({dq(c)} IGNORE NULLS) {over} AS {dq(c)}" if c in fill else dq(c) for c in columns) + f" FROM ({source})"


def _roll_sql(columns, fill, concat, key, source, extra=""):
    filled = _fill_sql(columns, fill, source)
    k = dq(key)
    cleaned = "SELECT _ord, " + ", ".join(
        f"CASE WHEN {dq(c)} NOT IN ('<NA>', 'NA') THEN {dq(c)} END AS {dq(c)}" for c in columns) + f" FROM ({filled})"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY _ord) AS rn FROM ({cleaned})"
    cells = []
    for c in columns:
        if c == key:
            cells.append(k)
        elif c in concat:
            cells.append(f"CASE WHEN {k} IS NOT NULL THEN coalesce(string_agg({dq(c)}, ',' ORDER BY _ord), '') END AS {dq(c)}")
        else:
            cells.append(f"max(CASE WHEN rn = 1 THEN {dq(c)} END) AS {dq(c)}")
    return f"SELECT {', '.join(cells)}{extra} FROM ({ranked}) GROUP BY {k}"


EXPORT_SQL = "SELECT event_id AS _ord, " + ", ".join(f"{e} AS {dq(n)}" for n, e in EXPORT) + " FROM events"
ROLLED_SQL = _roll_sql(ROLLED, L.PARTICIPANT_FILL, L.PARTICIPANT_CONCAT, "SP ID", EXPORT_SQL)


@query(ROLLED_SQL)
def g1_rolled_participants(spark, sf):
    return participants.rolled_participants(export(spark, sf), CENTER, ANSWERS)


PICKED = ", ".join(
    f"""(SELECT {dq(value)} FROM f WHERE f."SP ID" = k."SP ID" AND {dq(L.QUESTION)} = '{question}'
        ORDER BY _ord DESC LIMIT 1) AS {dq(out)}""" for out, (question, value) in L.FEEDBACK_PICKS.items())


@query(f"""WITH f AS ({_fill_sql(ROLLED, L.PARTICIPANT_FILL, EXPORT_SQL)}), k AS (SELECT DISTINCT "SP ID" FROM f)
       SELECT "SP ID", {PICKED} FROM k""")
def g1_interviewer_feedback(spark, sf):
    rolled = participants.rolled_participants(export(spark, sf), CENTER, ANSWERS, include_feedback=True)
    return rolled.select(col("SP ID"), *[col(c) for c in L.FEEDBACK_PICKS])


@query(f"SELECT DISTINCT {', '.join(map(dq, FILLED))} FROM ({_fill_sql(EXPORT_COLUMNS, L.PARTICIPANT_FILL, EXPORT_SQL)})")
def g1_filled_rows(spark, sf):
    return participants.filled_rows(export(spark, sf), CENTER)


MAPPING = ("CAST(c_custkey AS STRING) AS `SP ID`", "concat('P', CAST(c_custkey AS STRING)) AS `Person Id`", "c_name AS Name")
MAPPED_SQL = f"""SELECT r.*, CASE WHEN c_custkey IS NULL THEN '' ELSE concat('P', c_custkey) END AS "Person Id", coalesce(c_name, '') AS "Name"
    FROM ({ROLLED_SQL}) r LEFT JOIN customer ON "SP ID" = CAST(c_custkey AS VARCHAR) AND c_mktsegment <> 'BUILDING'"""


@query(MAPPED_SQL)
def g2_mapped_participants(spark, sf):
    mapping = load(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").selectExpr(*MAPPING)
    return participants.map_ids(g1_rolled_participants(spark, sf), mapping)


# Export as the allocation reads it. Few rows say what was done, so some records never do; a missing end date spoils a record's dates.
FROM_YEAR = "2000 + CAST(minute(ts) AS INT)"
KNOWN = "CASE WHEN value >= 180 THEN {} END"
RAW = {
    "SP ID": "CASE WHEN event_type = 'view' THEN CAST(user_id AS STRING) END",
    "Work Experience/Company": "CASE WHEN value >= 5 THEN props END",
    "Work Experience/Designation": KNOWN.format("event_type"),
    "Work Experience/Tasks": "concat('task ', event_type)",
    "Work Experience/Industry": "event_type",
    "Work Experience/From Date": f"concat(CAST({FROM_YEAR} AS STRING), '-1-5')",
    "Work Experience/To Date": f"""CASE WHEN value < 300 THEN concat(CAST({FROM_YEAR} + 1 AS STRING), '-',
        CAST(1 + CAST(floor(least(value, 11)) AS INT) AS STRING), '-02') END""",
    "Education/Qualifications": KNOWN.format("CASE WHEN value >= 200 THEN concat('q ', event_type) END"),
    "Education/Specialization": KNOWN.format("concat('s ', event_type)"),
    "Skills": "CASE WHEN value >= 50 THEN concat('skill ', event_type) END",
    "Any Additional Skills": "CASE WHEN value >= 20 THEN props END",
    "Computer Skills": "CASE WHEN value >= 10 THEN 'typing' END",
    "Languages": "CASE WHEN event_type <> 'error' THEN upper(event_type) END",
    "Gender": "CASE WHEN value >= 5 THEN event_type END",
    "Age": "CASE WHEN value >= 15 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) END",
}
FILL = [c for c in L.ALLOCATION_COLUMNS if c not in L.ALLOCATION_LISTS]


def raw_participants(spark, sf):
    return load(spark, sf, "events").selectExpr(
        f"event_id AS {ORDER}", *[f"{RAW[c]} AS {quoted(c)}" for c in L.ALLOCATION_COLUMNS])


def frame(spark, sf):
    return participants.participant_frame(raw_participants(spark, sf))


RAW_SQL = "SELECT event_id AS _ord, value, " + ", ".join(f"{RAW[c]} AS {dq(c)}" for c in L.ALLOCATION_COLUMNS) + " FROM events"
WORDED = "SELECT _ord, value, " + ", ".join(
    dq(c) if c == "SP ID" else f"""CASE WHEN "SP ID" IS NOT NULL THEN coalesce({dq(c)}, 'NA') ELSE {dq(c)} END AS {dq(c)}"""
    for c in L.ALLOCATION_COLUMNS) + f" FROM ({RAW_SQL})"
FRAME_SQL = f"""WITH w AS ({WORDED}), f AS ({_fill_sql(['value', *L.ALLOCATION_COLUMNS], FILL, 'w')}),
    n AS (SELECT *, row_number() OVER (PARTITION BY "SP ID" ORDER BY _ord) AS rn FROM f),
    b AS (SELECT "SP ID" AS bk, count(*) <> count("Work Experience/To Date")
        OR count(*) FILTER ("Work Experience/To Date" = 'NA') > 0 AS broken FROM n GROUP BY bk)
    SELECT CAST("SP ID" AS BIGINT) AS "SP ID", any_value(broken) AS broken,
      {', '.join(f"max(CASE WHEN rn = 1 THEN {dq(c)} END) AS {dq(c)}" for c in FILL if c != 'SP ID')},
      {', '.join(f'''coalesce(string_agg({dq(c)}, ' ~ ' ORDER BY _ord), '') AS {dq(c)}''' for c in L.ALLOCATION_LISTS if 'Date' not in c)},
      {', '.join(f'''CASE WHEN any_value(broken) THEN 'NA' ELSE string_agg({dq(c)}, ' ~ ' ORDER BY _ord) END AS {dq(c)}'''
                 for c in L.ALLOCATION_LISTS if 'Date' in c)},
      CASE WHEN NOT any_value(broken) THEN string_agg(CAST(round(date_diff('day',
        make_date(TRY_CAST("Work Experience/From Date"[1:4] AS INT), 1, 5),
        make_date(TRY_CAST("Work Experience/To Date"[1:4] AS INT), 1 + CAST(floor(least(value, 11)) AS INT), 2)) / 365.0::DOUBLE, 2)
        AS VARCHAR), ' ~ ' ORDER BY _ord) END AS years,
      concat(chr(10), 'Participant ', "SP ID", ' has the following work experience: ',
        CASE WHEN any_value(broken) THEN max(CASE WHEN rn = 1 THEN concat('A ', "Work Experience/Industry",
            ' in the industry doing ', "Work Experience/Tasks", ' tasks.') END)
          ELSE string_agg(concat('A ', "Work Experience/Industry", ' in the industry doing ', "Work Experience/Tasks",
            ' tasks for ', 12 + CAST(floor(least(value, 11)) AS INT), ' months.'), ' ' ORDER BY _ord) END, chr(10),
        'They have the following qualifications: [',
        coalesce(string_agg(concat('''', "Education/Qualifications", ''''), ', ' ORDER BY _ord)
          FILTER ("Education/Qualifications" IS NOT NULL), ''''''), '] in [',
        coalesce(string_agg(concat('''', "Education/Specialization", ''''), ', ' ORDER BY _ord)
          FILTER ("Education/Specialization" IS NOT NULL), ''''''), '].', chr(10), 'They have the following skills: [',
        coalesce(string_agg(concat('''', "Skills", ''''), ', ' ORDER BY _ord) FILTER ("Skills" IS NOT NULL), ''''''),
        '] and ', max(CASE WHEN rn = 1 THEN "Any Additional Skills" END), ' and computer skill ', chr(10),
        max(CASE WHEN rn = 1 THEN "Computer Skills" END), ' and know the following languages: ',
        coalesce(string_agg("Languages", '.' ORDER BY _ord), ''), '.', chr(10), 'The participant is a ',
        max(CASE WHEN rn = 1 THEN "Gender" END), ' and ', max(CASE WHEN rn = 1 THEN "Age" END), ' years old.', chr(10)) AS summary
    FROM n JOIN b ON bk = "SP ID" GROUP BY "SP ID"
    UNION ALL SELECT NULL, true, {', '.join(f"max(CASE WHEN rn = 1 THEN {dq(c)} END)" for c in FILL if c != 'SP ID')},
      {', '.join('NULL' for _ in L.ALLOCATION_LISTS)}, NULL, NULL FROM n WHERE "SP ID" IS NULL HAVING count(*) > 0"""


@query(FRAME_SQL)
def e5_participant_frame(spark, sf):
    """The rows before the first key are a record of null key, without lists."""
    made = frame(spark, sf)
    years = col("Years of Experience")
    return made.select(
        *[col(c) for c in FILL], years.isNull().alias("broken"), "summary",
        *[F.array_join(col(c), " ~ ").alias(c) for c in L.ALLOCATION_LISTS],
        F.array_join(F.transform(years, lambda y: y.cast("string")), " ~ ", "null").alias("years"))


def search_inputs(spark, sf):
    """Participants with the embedding of their number as search vector."""
    texts = allocation.retrieval_input(frame(spark, sf))
    vecs = load(spark, sf, "embeddings").select("vec_id", "embedding")
    return texts.join(vecs, col("SP ID") == F.col("vec_id"), "left").drop("vec_id")


def job_table(spark, sf):
    return load(spark, sf, "part").selectExpr("p_partkey AS _ord", "p_type AS `Job Title`", "p_brand AS Department")


def results(spark, sf):
    return allocation.allocate(search_inputs(spark, sf), job_nodes(spark, sf), job_table(spark, sf), "embedding")


SHOWN = L.INPUT_COLUMNS[1:]
REPR = ", ".join(f"""concat('[', coalesce(string_agg(concat('''', {dq(c)}, ''''), ', ' ORDER BY _ord) FILTER ({dq(c)} IS NOT NULL),
    ''''''), ']') AS {dq(c)}""" for c in SHOWN)
KNOWS = " OR ".join(f"count(*) FILTER ({dq(c)} <> 'NA') > 0" for c in SHOWN)
RESULTS_SQL = f"""WITH w AS ({WORDED}), f AS ({_fill_sql(['value', *L.ALLOCATION_COLUMNS], FILL, 'w')}),
    people AS (SELECT CAST("SP ID" AS BIGINT) AS "SP ID", {REPR}, {KNOWS} AS knows FROM f WHERE "SP ID" IS NOT NULL GROUP BY "SP ID"),
    {{HITS}},
    labels AS (SELECT p_type, string_agg(p_brand, ', ' ORDER BY seen) AS depts FROM (
      SELECT p_type, p_brand, min(p_partkey) AS seen FROM part GROUP BY ALL) GROUP BY p_type),
    wide AS (SELECT "SP ID", {', '.join(f'''coalesce(max(title) FILTER (rank = {i}), 'Ashram Support') AS "Vec Pred Job Title: {i}",
        coalesce(max(request) FILTER (rank = {i}), '') AS "Vec Pred Request Name: {i}",
        round(coalesce(max(score) FILTER (rank = {i}), 0), 6) AS "Vec Pred Score: {i}"''' for i in (1, 2, 3))},
      {', '.join(f'any_value({dq(c)}) AS {dq(c)}' for c in SHOWN)}
      FROM people LEFT JOIN hits ON vec_id = "SP ID" GROUP BY "SP ID")
    SELECT wide.*, {', '.join(f'''concat("Vec Pred Job Title: {i}", ': ', l{i}.depts, ' ') AS "Department {i}"''' for i in (1, 2, 3))}
    FROM wide {' '.join(f'LEFT JOIN labels l{i} ON l{i}.p_type = "Vec Pred Job Title: {i}"' for i in (1, 2, 3))}"""


HITS_SQL = f"""n AS (SELECT * FROM ({NODES.format(v=VECTORS)})),
    hits AS (SELECT q.vec_id, n.title, n.request, list_cosine_similarity(q.v, n.v) AS score, row_number() OVER (
        PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.v, n.v), 9) DESC, n.id) AS rank
      FROM ({VECTORS}) q CROSS JOIN n WHERE q.vec_id IN (SELECT "SP ID" FROM people WHERE knows))"""
ALLOCATED_SQL = RESULTS_SQL
RESULTS_SQL = ALLOCATED_SQL.replace("{HITS}", HITS_SQL)


def _printed(df):
    return df.select(*[
        list_repr(col(c)).alias(c) if c in SHOWN else F.round(col(c), 6).alias(c) if c.startswith("Vec Pred Score") else col(c)
        for c in df.columns])


@query(RESULTS_SQL)
def g3_allocate(spark, sf):
    return _printed(results(spark, sf))


def enriched(spark, sf):
    """Results go through their snapshot, the way the next step reads them."""
    base = scratch_path(spark, "results")
    write_snapshot(results(spark, sf), base)
    return allocation.enrich_results(read_snapshot(spark, base), g1_rolled_participants(spark, sf))


ENRICHED_SQL = f"""SELECT CAST(r."SP ID" AS VARCHAR) AS "SP ID", r.* EXCLUDE ("SP ID", "Vec Pred Score: 1", "Vec Pred Score: 2",
    "Vec Pred Score: 3"), "Languages", {dq(L.GRADUATION)} FROM ({RESULTS_SQL}) r
    LEFT JOIN (SELECT "SP ID", "Languages", {dq(L.GRADUATION)} FROM ({ROLLED_SQL})) p
    ON p."SP ID" = CAST(r."SP ID" AS VARCHAR)"""


@query(ENRICHED_SQL)
def g4_enrich_results(spark, sf):
    return _printed(enriched(spark, sf))


FILLED_SQL = f"SELECT DISTINCT {', '.join(map(dq, FILLED))} FROM ({_fill_sql(EXPORT_COLUMNS, L.PARTICIPANT_FILL, EXPORT_SQL)})"
HELD = f"""{dq('SP ID')} IS NOT NULL AND {dq(L.SUMMARY)} IS NOT NULL"""


@query(f"""WITH s AS ({FILLED_SQL}), r AS (SELECT "SP ID" FROM ({ROLLED_SQL})), c AS (SELECT CAST(c_custkey AS VARCHAR) AS k
         FROM customer WHERE c_mktsegment = 'BUILDING')
       SELECT 'filled' AS job, count(*) FILTER ({HELD}) AS rows_before, count(*) - count(*) FILTER ({HELD}) AS rows_added,
         count(*) AS rows_after, count(DISTINCT "SP ID") AS distinct_keys FROM s
       UNION ALL SELECT 'participants', (SELECT count(*) FROM c), count(*) FILTER ("SP ID" IS NULL OR "SP ID" NOT IN (SELECT k FROM c)),
         (SELECT count(*) FROM c) + count(*) FILTER ("SP ID" IS NULL OR "SP ID" NOT IN (SELECT k FROM c)), count("SP ID") FROM r
       UNION ALL SELECT 'predictions', (SELECT count(*) FROM c), count(*) FILTER ("SP ID" IS NULL OR "SP ID" NOT IN (SELECT k FROM c)),
         (SELECT count(*) FROM c) + count(*) FILTER ("SP ID" IS NULL OR "SP ID" NOT IN (SELECT k FROM c)), count("SP ID") FROM r""")
def g5_sync_reports(spark, sf):
    rolled, filled = participants.roll_up_participants(export(spark, sf), CENTER, ANSWERS)
    held = filled.where(col("SP ID").isNotNull() & col(L.SUMMARY).isNotNull())
    known = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").selectExpr("concat(CAST(c_custkey AS STRING), ' ') AS `SP ID`")
    reports = [
        ("filled", sync.sync_filled(filled, held)), ("participants", sync.sync_participants(rolled, known)),
        ("predictions", sync.sync_predictions(rolled.select("SP ID"), known)),
    ]
    rows = [report.select(F.lit(job).alias("job"), "*") for job, (_, report) in reports]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


@query("""SELECT CAST(c_custkey AS VARCHAR) AS person, c_name AS title, 'r' AS request FROM customer
       UNION ALL SELECT CAST(s_suppkey + 1000000 AS VARCHAR), s_name, NULL FROM supplier""")
def g5_append_predictions(spark, sf):
    """A table of every second customer gains the other ones, then suppliers by position in a narrower layout."""
    path = scratch_path(spark, "predictions")
    people = load(spark, sf, "customer").selectExpr("CAST(c_custkey AS STRING) AS person", "c_name AS title", "'r' AS request")
    append_rows(people.where("person % 2 = 0"), path)
    for _ in (1, 2):  # a batch that is sent again adds nothing
        sync.append_predictions(people.withColumnsRenamed({"person": L.KEY, "title": "Pred Job Title: 1"}), path, "all")
    more = load(spark, sf, "supplier").selectExpr(f"CAST(s_suppkey + 1000000 AS STRING) AS `{L.KEY}`", "s_name AS other")
    sync.append_predictions(more, path)
    return read_appended(spark, path)


def predictions(spark, sf):
    """Predictions whose first title is a research job wherever the economy line comes first."""
    made = allocation.to_predictions(enriched(spark, sf))
    title = col("Pred Job Title: 1")
    return made.withColumn("Pred Job Title: 1", F.when(title == "ECONOMY", "Researcher").otherwise(title))


PREDICTED_SQL = f"""SELECT * REPLACE (CASE WHEN "Vec Pred Job Title: 1" = 'ECONOMY' THEN 'Researcher'
    ELSE "Vec Pred Job Title: 1" END AS "Vec Pred Job Title: 1") FROM ({ENRICHED_SQL})"""
TWEAKED_SQL = f"""SELECT * REPLACE (CASE WHEN "Vec Pred Job Title: 1" <> 'Researcher' OR trim("Work Experience/Designation") <> '[''NA'']'
      THEN "Vec Pred Job Title: 1"
    WHEN "Education/Qualifications" = '[''NA'']' AND "Education/Specialization" = '[''NA'']' THEN 'Ashram Support'
    WHEN coalesce(TRY_CAST({dq(L.GRADUATION)} AS DOUBLE), 0) IN (2023, 2024, 2025) THEN 'Fresher'
    ELSE 'Ashram Support' END AS "Vec Pred Job Title: 1") FROM ({PREDICTED_SQL})"""
RANKED_SQL = " UNION ALL ".join(
    f"""SELECT "SP ID", "Vec Pred Job Title: {i}" AS "Job Title Prediction", "Vec Pred Request Name: {i}" AS "VRF ID",
    coalesce(trim(split_part("Department {i}", ':', 2)), 'NA') AS "Department", {i} AS "Rank" FROM ({TWEAKED_SQL})"""
    for i in (1, 2, 3))


@query(RANKED_SQL)
def g6_ranked_predictions(spark, sf):
    return allocation.format_predictions(allocation.tweak_predictions(predictions(spark, sf)))


# Job requests drawn from the parts: large parts open a request, the parts after them continue it.
REQUEST = {
    "Request Name": "CASE WHEN p_size > 40 THEN concat(p_name, ' ', p_brand) END", "Job Title": "p_type",
    "Job Description": "CASE WHEN p_size > 10 THEN concat('about ', p_name) END", "Gender Preference": "p_brand",
    "# of Volunteers": "CAST(p_size AS STRING)", "Skills/Keywords": "CASE WHEN p_size > 5 THEN p_name WHEN p_size > 2 THEN 'NA' END",
    "Educational Qualification": "CASE WHEN p_size < 20 THEN p_brand END", "Department": "p_brand",
    "Languages": "CASE WHEN p_size > 25 THEN p_type END",
}
RAW_REQUESTS_SQL = "SELECT p_partkey AS _ord, " + ", ".join(f"{e} AS {dq(n)}" for n, e in REQUEST.items()) + " FROM part"
REQUEST_COLUMNS = [c for c in L.REQUEST_ORDER if c in REQUEST]
CLEAN_SQL = f"""SELECT *, '' AS "Skills" FROM ({_roll_sql(REQUEST_COLUMNS, ['Request Name'], L.REQUEST_CONCAT, 'Request Name',
    RAW_REQUESTS_SQL)})"""


def raw_requests(spark, sf):
    return load(spark, sf, "part").selectExpr(f"p_partkey AS {ORDER}", *[f"{e} AS {quoted(n)}" for n, e in REQUEST.items()])


@query(CLEAN_SQL)
def g7_clean_requests(spark, sf):
    return requests.clean_requests(raw_requests(spark, sf))


def _requests(spark, sf, where):
    """Requests known before, one row each, in the layout of the backend tables."""
    return load(spark, sf, "part").where(where).selectExpr(
        f"p_partkey AS {ORDER}", "concat(p_name, ' ', p_brand) AS `Request Name`", "p_type AS `Job Title`",
        "p_retailprice AS price")


def _requests_sql(where):
    return f"""SELECT p_partkey AS _ord, concat(p_name, ' ', p_brand) AS "Request Name", p_type AS "Job Title", p_retailprice AS price
        FROM part WHERE {where}"""


NEW_WHERE, OLD_WHERE, MAIN_WHERE = "p_size BETWEEN 20 AND 30", "p_size < 25", "p_size > 15"


RECONCILED_SQL = f"""new AS ({_requests_sql(NEW_WHERE)}), clean AS (SELECT "Request Name", min(p_partkey) AS _ord, any_value("Job Title") AS "Job Title"
         FROM (SELECT p_partkey, concat(p_name, ' ', p_brand) AS "Request Name", first_value(p_type) OVER (
           PARTITION BY concat(p_name, ' ', p_brand) ORDER BY p_partkey) AS "Job Title" FROM part WHERE p_size > 40) GROUP BY 1),
       fresh AS (SELECT * FROM clean WHERE "Request Name" NOT IN (SELECT "Request Name" FROM new)),
       u AS (SELECT _ord, "Request Name", "Job Title", price, 0 AS src, 'Old VRF ID' AS status FROM ({_requests_sql(OLD_WHERE)})
         UNION ALL SELECT _ord, "Request Name", "Job Title", price, 1, 'New VRF ID' FROM new
         UNION ALL SELECT _ord, "Request Name", "Job Title", NULL, 2, 'New VRF ID' FROM fresh),
       m AS (SELECT "Request Name", "Job Title", price, status FROM u QUALIFY row_number() OVER (
         PARTITION BY "Request Name" ORDER BY src DESC, _ord DESC) = 1)"""


@query(f"""WITH {RECONCILED_SQL} SELECT "Request Name", "Job Title", price, status AS "VRF ID Status" FROM m
       UNION ALL SELECT "Request Name", "Job Title", price, NULL FROM ({_requests_sql(MAIN_WHERE)})
       WHERE "Request Name" NOT IN (SELECT "Request Name" FROM m)""")
def g8_reconcile_requests(spark, sf):
    return _reconciled(spark, sf)[2]


@query(f"""WITH {RECONCILED_SQL} SELECT _ord, "Request Name", "Job Title" FROM fresh""")
def g8_rows_to_append(spark, sf):
    return _reconciled(spark, sf)[0].select(ORDER, "Request Name", "Job Title")


@query(f"""WITH {RECONCILED_SQL} SELECT "Request Name", "Job Title", price, status AS "VRF ID Status" FROM m""")
def g8_merged_requests(spark, sf):
    return _reconciled(spark, sf)[1]


def _reconciled(spark, sf):
    firsts = load(spark, sf, "part").where("p_size > 40").selectExpr(
        f"p_partkey AS {ORDER}", "concat(p_name, ' ', p_brand) AS `Request Name`", "p_type AS `Job Title`")
    clean = keep_first(firsts, ["Request Name"])
    return requests.reconcile_requests(
        clean, _requests(spark, sf, NEW_WHERE), _requests(spark, sf, OLD_WHERE),
        _requests(spark, sf, MAIN_WHERE).drop(ORDER))


def filled_requests(spark, sf):
    return fill_down(raw_requests(spark, sf).withColumn("Skills", F.lit(None).cast("string")), ["Request Name"])


def generic_jobs(spark, sf):
    return load(spark, sf, "part").where("p_size = 1").selectExpr(
        f"p_partkey AS {ORDER}", "p_type AS `Job Title`", f"p_name AS `{L.GENERIC_DESCRIPTION}`")


def job_texts(spark, sf):
    return requests.job_texts(filled_requests(spark, sf), generic_jobs(spark, sf))


def _list_sql(name):
    return f"""coalesce(string_agg({dq(name)}, ', ' ORDER BY _ord), '')"""


TEXTS_SQL = f"""WITH e AS ({_fill_sql(list(REQUEST), ['Request Name'], RAW_REQUESTS_SQL)}),
    k AS (SELECT _ord, {', '.join(dq(c) if c == 'Request Name' else f"coalesce({dq(c)}, 'NA') AS {dq(c)}" for c in REQUEST)}
      FROM e WHERE "Request Name" IS NOT NULL),
    n AS (SELECT *, row_number() OVER (PARTITION BY "Request Name" ORDER BY _ord) AS rn FROM k),
    g AS (SELECT "Request Name", min(_ord) AS seen, max(CASE WHEN rn = 1 THEN "Job Title" END) AS "Job Title",
      max(CASE WHEN rn = 1 THEN "Department" END) AS "Department", max(CASE WHEN rn = 1 THEN "Job Description" END) AS about,
      {_list_sql('Skills/Keywords')} AS keywords, string_agg('NA', ', ') AS skills, {_list_sql('Languages')} AS langs FROM n GROUP BY 1)
    SELECT "Job Title", "Request Name", "Department", concat(chr(10), '    The job titled: "', "Job Title", '" has a description: ',
      about, ',', chr(10), '    and expects the following skills: ', keywords, ', and ', skills, chr(10),
      '    and know the languages: ', langs, '.', chr(10), '    ') AS summary, 0 AS src, seen FROM g
    UNION ALL SELECT p_type, '', '', concat(chr(10), '    The job titled: "', p_type, '" has a description: ', p_name, '.', chr(10), '    '),
      1, p_partkey FROM part WHERE p_size = 1"""


@query(f"""SELECT "Job Title", "Request Name", "Department", summary FROM ({TEXTS_SQL})""")
def t4_job_texts(spark, sf):
    return job_texts(spark, sf).select("Job Title", "Request Name", "Department", "summary")


# The vector table: jobs numbered in row order, requests first, and the weights of their terms summed by place.
WIDTH = 64
PLACED_SQL = f"""places AS (SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {WIDTH} AS place, sum(tf * idf)::FLOAT AS w FROM (
      SELECT id, term, tf, ln(((SELECT count(*) FROM nodes) + 1) / (count(*) OVER (PARTITION BY term) + 1)) AS idf FROM (
        SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM nodes)
        WHERE term <> '' GROUP BY ALL)) GROUP BY ALL)"""
NODES_SQL = f"""nodes AS (SELECT CAST(row_number() OVER (ORDER BY src, seen) - 1 AS VARCHAR) AS id, summary AS text, "Job Title",
      "Request Name", "Department" FROM ({TEXTS_SQL})), {PLACED_SQL}"""


@query(f"""WITH {NODES_SQL} SELECT id, text, "Job Title", "Request Name", "Department", CAST(place AS INTEGER) AS place,
       round(w::DOUBLE, 4) AS x FROM nodes JOIN places USING (id) WHERE round(w::DOUBLE, 4) <> 0""")
def v1_index_nodes(spark, sf):
    nodes = requests.index_nodes(job_texts(spark, sf), lambda d, k, t: embed_text(d, k, t, WIDTH))
    cells = nodes.select(*[col(c) for c in nodes.columns if c != "embedding"], F.posexplode("embedding").alias("place", "x"))
    return cells.withColumn("x", F.round(F.col("x").cast("double"), 4)).where("x <> 0")


# Participants meet the indexed jobs by their search texts, in the weights of the job texts.
_LISTS = ", ".join(f"coalesce(list({dq(c)} ORDER BY _ord) FILTER ({dq(c)} IS NOT NULL), ['NA']) AS c{i}"
                   for i, c in enumerate(L.INPUT_COLUMNS[1:]))
FOUND_SQL = f"""{NODES_SQL},
    lists AS (SELECT CAST("SP ID" AS BIGINT) AS k, {_LISTS} FROM f WHERE "SP ID" IS NOT NULL GROUP BY "SP ID"),
    heads AS (SELECT *, concat(' Participant ', k, ' worked with designations: ', array_to_string(
      list_transform(c0, lambda d: concat(d, ', ')), '')) AS head FROM lists),
    texts AS (SELECT k, concat(head, left(head, length(head) - 2), '. ', array_to_string(list_transform(
      range(1, least(len(c1), len(c2)) + 1), lambda i: concat(' The participant has a ', c1[i], ' education specialized in ',
      c2[i], '. ')), '')) AS input FROM heads),
    idfs AS (SELECT term, ln(((SELECT count(*) FROM nodes) + 1) / (count(DISTINCT id) + 1)) AS idf FROM (
      SELECT id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS term FROM nodes) WHERE term <> '' GROUP BY term),
    asked AS (SELECT k, ('0x' || substr(md5(term), 1, 8))::BIGINT % {WIDTH} AS place, sum(tf * idf)::FLOAT AS w FROM (
      SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(regexp_split_to_array(lower(input), '\\s+')) AS term FROM texts)
      GROUP BY ALL) JOIN idfs USING (term) GROUP BY ALL),
    dots AS (SELECT k, id, sum(a.w::DOUBLE * b.w::DOUBLE) AS dot FROM asked a JOIN places b USING (place) GROUP BY ALL),
    sizes AS (SELECT k, sqrt(sum(w::DOUBLE * w::DOUBLE)) AS n FROM asked GROUP BY k),
    lengths AS (SELECT id, sqrt(sum(w::DOUBLE * w::DOUBLE)) AS n FROM places GROUP BY id),
    hits AS (SELECT k AS vec_id, "Job Title" AS title, "Request Name" AS request, score, row_number() OVER (
        PARTITION BY k ORDER BY round(score, 9) DESC, id) AS rank FROM (
      SELECT s.k, n.id, "Job Title", "Request Name", coalesce(dot / (s.n * l.n), 0) AS score FROM sizes s CROSS JOIN nodes n
        JOIN lengths l ON l.id = n.id LEFT JOIN dots d ON d.k = s.k AND d.id = n.id
      WHERE s.k IN (SELECT "SP ID" FROM people WHERE knows)))"""


# Departments of the raw requests, as the job lists them per title.
DEPARTMENTS_SQL = f"""labels AS (SELECT "Job Title" AS p_type, string_agg("Department", ', ' ORDER BY seen) AS depts FROM (
      SELECT "Job Title", "Department", min(_ord) AS seen FROM ({RAW_REQUESTS_SQL}) GROUP BY 1, 2) GROUP BY 1),
    """


def _v6_sql():
    start, end = ALLOCATED_SQL.index("labels AS ("), ALLOCATED_SQL.index("wide AS (")
    return (ALLOCATED_SQL[:start] + DEPARTMENTS_SQL + ALLOCATED_SQL[end:]).replace("{HITS}", FOUND_SQL)


@query(_v6_sql())
def v6_allocation_job(spark, sf):
    return _printed(allocation.allocation_job(
        frame(spark, sf), filled_requests(spark, sf), generic_jobs(spark, sf), scratch_path(spark, "vectors"),
        scratch_path(spark, "results"), width=WIDTH))


TAG_NAMES = ("k", "Specialization")


def _people(spark, sf):
    return load(spark, sf, "events").selectExpr(
        "CAST(event_id AS STRING) AS `SP ID`", "CASE WHEN value >= 10 THEN event_type ELSE '' END AS `First Name`",
        "CASE WHEN value >= 5 THEN props END AS Name", "CASE WHEN value >= 15 THEN event_type END AS City")


def _replies(spark, sf):
    return load(spark, sf, "events").selectExpr("CAST(event_id AS STRING) AS `SP ID`", REPLY)


def _tagged(spark, sf):
    return tags.tag_records(_people(spark, sf), _replies(spark, sf), TAG_NAMES, at="2024-01-01 00:00:00")


TAGGED_SQL = """SELECT CAST(event_id AS VARCHAR) AS "SP ID", CASE WHEN value >= 10 THEN event_type
      WHEN event_type = 'error' THEN '' WHEN value >= 5 THEN props ELSE '' END AS "Name",
    CASE WHEN value >= 15 THEN event_type ELSE '' END AS "City", '2024-01-01 00:00:00' AS "Processed Date",
    CASE WHEN event_type = 'error' THEN 'Processing failed' WHEN event_type = 'view' THEN json_extract_string(props, '$.k')
      WHEN event_type = 'signup' THEN props ELSE 'No info found' END AS k,
    CASE WHEN event_type = 'error' THEN 'Processing failed' ELSE 'No info found' END AS "Specialization" FROM events"""


@query(TAGGED_SQL)
def g9_tag_records(spark, sf):
    return _tagged(spark, sf).withColumn("k", F.regexp_replace("k", '":(?=\\d)', '": '))


@query(TAGGED_SQL)
def e13_tag_job(spark, sf):
    """Tags appended in two runs, the second over all candidates; each is in the table once."""
    people, replies = _people(spark, sf), _replies(spark, sf)
    path = scratch_path(spark, "tags")
    tags.append_tags(people.where("Name IS NOT NULL"), replies, path, TAG_NAMES, at="2024-01-01 00:00:00")
    tags.append_tags(people, replies, path, TAG_NAMES, at="2024-01-01 00:00:00")
    return read_appended(spark, path).withColumn("k", F.regexp_replace("k", '":(?=\\d)', '": '))


@query("""SELECT CAST(event_id AS VARCHAR) AS "SP ID", event_type AS type, value FROM events""")
def e10_prompts(spark, sf):
    people = load(spark, sf, "events").selectExpr("CAST(event_id AS STRING) AS `SP ID`", "event_type AS type", "value")
    asked = tags.prompts(people)
    back = F.from_json("record", "type string, value double")
    return asked.select("SP ID", back.alias("r")).select("SP ID", "r.type", "r.value")


STRUCTURED_SQL = f"""WITH w AS ({WORDED}), f AS ({_fill_sql(['value', *L.ALLOCATION_COLUMNS], FILL, 'w')}),
    n AS (SELECT *, row_number() OVER (PARTITION BY "SP ID" ORDER BY _ord) AS rn,
      count(*) OVER p <> count("Work Experience/To Date") OVER p OR count(CASE WHEN "Work Experience/To Date" = 'NA' THEN 1 END)
      OVER p > 0 AS broken FROM f WHERE "SP ID" IS NOT NULL WINDOW p AS (PARTITION BY "SP ID"))
    SELECT CAST("SP ID" AS BIGINT) AS "SP ID", first_value("Gender") OVER k AS "Gender", first_value("Age") OVER k AS "Age",
      CASE WHEN broken THEN 'NA' ELSE "Work Experience/From Date" END AS "Work Experience/From Date",
      CASE WHEN broken THEN 'NA' ELSE "Work Experience/To Date" END AS "Work Experience/To Date"
    FROM n WINDOW k AS (PARTITION BY "SP ID" ORDER BY _ord) QUALIFY NOT broken OR rn = 1
    UNION ALL SELECT NULL, coalesce(arg_min_null("Gender", _ord), 'NA'), coalesce(arg_min_null("Age", _ord), 'NA'), 'NA', 'NA' FROM f
    WHERE "SP ID" IS NULL HAVING count(*) > 0"""


def published(spark, sf):
    database.publish_participants(frame(spark, sf))


@query(STRUCTURED_SQL)
def g10_structured_table(spark, sf):
    published(spark, sf)
    return run_sql(spark, "SELECT * FROM participants_structured")


@query(f"""WITH w AS ({WORDED}), f AS ({_fill_sql(['value', *L.ALLOCATION_COLUMNS], FILL, 'w')})
       SELECT CAST("SP ID" AS BIGINT) AS "SP ID", "Languages" FROM f WHERE "Languages" IS NOT NULL AND "SP ID" IS NOT NULL
       UNION ALL SELECT CAST("SP ID" AS BIGINT), '' FROM f WHERE "SP ID" IS NOT NULL GROUP BY "SP ID" HAVING count("Languages") = 0
       UNION ALL SELECT NULL, 'NA' FROM f WHERE "SP ID" IS NULL HAVING count(*) > 0""")
def g10_language_table(spark, sf):
    published(spark, sf)
    return run_sql(spark, "SELECT * FROM participants_languages")


@query(ORACLES["g10_structured_table"])
def g10_structured_rows(spark, sf):
    """The same from list items, in blocks of fewer rows than most records have."""
    return database.structured_rows(*database.participant_items(raw_participants(spark, sf), block=64))


@query(ORACLES["g10_language_table"])
def g10_language_rows(spark, sf):
    return database.language_rows(*database.participant_items(raw_participants(spark, sf), block=64))


UNSTRUCTURED_SQL = f"""WITH w AS ({WORDED}), f AS ({_fill_sql(['value', *L.ALLOCATION_COLUMNS], FILL, 'w')}),
    n AS (SELECT *, row_number() OVER (PARTITION BY "SP ID" ORDER BY _ord) AS rn FROM f WHERE "SP ID" IS NOT NULL)
    SELECT CAST("SP ID" AS BIGINT) AS "SP ID", {', '.join(
        f"coalesce(string_agg({dq(c)}, ', ' ORDER BY _ord), '') AS {dq(c)}" if c in L.ALLOCATION_LISTS
        else f"max(CASE WHEN rn = 1 THEN {dq(c)} END) AS {dq(c)}" for c in L.UNSTRUCTURED[1:])}
    FROM n GROUP BY "SP ID"
    UNION ALL SELECT NULL, {', '.join('NULL' if c in L.ALLOCATION_LISTS else f"arg_min_null({dq(c)}, _ord)" for c in L.UNSTRUCTURED[1:])}
    FROM f WHERE "SP ID" IS NULL HAVING count(*) > 0"""


@query(UNSTRUCTURED_SQL)
def g10_unstructured_table(spark, sf):
    published(spark, sf)
    return run_sql(spark, "SELECT * FROM participants_unstructured")


@query(f"""SELECT "SP ID", concat({", ' ', ".join(f"'{c}: ', {dq(c)}, chr(10)" for c in L.UNSTRUCTURED[1:])}) AS text
       FROM ({UNSTRUCTURED_SQL}) WHERE "SP ID" IS NOT NULL""")
def g10_search_texts(spark, sf):
    return database.search_texts(g10_unstructured_table(spark, sf).where(col("SP ID").isNotNull()))
