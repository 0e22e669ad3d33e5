"""Whole jobs from tab to tab; every query reads a sink back."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.operators.order import ORDER
from rollmatch.plans import layouts as L
from rollmatch.plans import sheets as S
from rollmatch.queries import jobs as J
from rollmatch.queries.jobs import dq
from rollmatch.queries.registry import query
from rollmatch.session import load, scratch_path
from rollmatch.sources.appendlog import read_appended
from rollmatch.sources.sinks import append_rows, write_snapshot, write_tab
from rollmatch.sources.tabs import read_tab


def _places(kind, spark):
    """A folder for everything the job reads or writes, with one CSV copy where it makes any."""
    base = scratch_path(spark, "sheets")
    return kind(**{f.name: (f"{base}/{f.name}",) if f.name.endswith("_csv") else f"{base}/{f.name}" for f in fields(kind)})


def _tab(spark, path):
    return read_tab(spark, path, order=None)


def _cells_sql(columns, sql):
    """What a tab gives back of these columns: texts, and null for a blank cell."""
    return "SELECT " + ", ".join(f"nullif(CAST({dq(c)} AS VARCHAR), '') AS {dq(c)}" for c in columns) + f" FROM ({sql})"


def _rolled(spark, sf):
    at = _places(S.ParticipantSheets, spark)
    write_tab(J.export(spark, sf, in_order=True).drop(ORDER), at.export)
    S.publish_rolled(spark, at, J.CENTER, J.ANSWERS)
    return at


@query(_cells_sql(J.ROLLED, J.ROLLED_SQL))
def g1_rolled_tab(spark, sf):
    return _tab(spark, _rolled(spark, sf).rolled)


def _final(spark, sf):
    at = _rolled(spark, sf)
    write_tab(load(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").selectExpr(*J.MAPPING), at.mapping)
    S.publish_final(spark, at)
    return at


FINAL = [L.KEY, "Person Id", "Name", *[c for c in J.ROLLED if c != L.KEY]]


@query(_cells_sql(FINAL, J.MAPPED_SQL))
def g2_final_csv(spark, sf):
    return _tab(spark, _final(spark, sf).final_csv[0])


@query(_cells_sql(J.FILLED, J.FILLED_SQL))
def g5_backend_filled(spark, sf):
    """The backend holds some rows; the tab's rows are sent twice as one batch, and once more as another one."""
    at = _rolled(spark, sf)
    rows = _tab(spark, at.filled)
    append_rows(rows.where(col(L.SUMMARY).isNotNull()), at.backend_filled)
    for batch in ("one", "one", "two"):
        S.sync_backend_filled(spark, at, batch)
    return read_appended(spark, at.backend_filled)


@query(f"""SELECT CAST(c_custkey AS VARCHAR) AS "SP ID", c_name AS "Name", 'x' AS city, 'known' AS note FROM customer
       WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT "SP ID", nullif("Name", ''), '', '' FROM ({J.MAPPED_SQL})
       WHERE "SP ID" IS NULL OR "SP ID" NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def g5_backend_participants(spark, sf):
    """The backend's layout has columns that the tab lacks, and the other way round."""
    at = _final(spark, sf)
    known = load(spark, sf, "customer").where("c_mktsegment = 'BUILDING'")
    append_rows(known.selectExpr("CAST(c_custkey AS STRING) AS `SP ID`", "c_name AS Name", "'x' AS city", "'known' AS note"),
                at.backend_participants)
    for batch in ("one", "one", "two"):
        S.sync_backend_participants(spark, at, batch)
    return read_appended(spark, at.backend_participants)


def _allocated(spark, sf):
    """Allocations whose first title is a research job wherever the economy line comes first."""
    at = _final(spark, sf)
    title = col(f"{L.TITLE_HEADING}: 1")
    made = J.results(spark, sf).withColumn(f"{L.TITLE_HEADING}: 1", F.when(title == "ECONOMY", "Researcher").otherwise(title))
    write_snapshot(made, at.results)
    S.publish_allocation(spark, at)
    return at


ALLOCATION = [L.KEY, *[f"{h}: {i}" for h in (L.TITLE_HEADING, L.REQUEST_HEADING) for i in (1, 2, 3)], *J.SHOWN,
              "Languages", "Department 1", "Department 2", "Department 3", L.GRADUATION]


@query(_cells_sql(ALLOCATION, J.PREDICTED_SQL))
def g4_allocation_csv(spark, sf):
    return _tab(spark, _allocated(spark, sf).allocation_csv[0])


@query(f"""SELECT "SP ID", "Job Title Prediction", coalesce(nullif("VRF ID", ''), 'NA') AS "VRF ID", nullif("Department", '') AS "Department",
       CAST("Rank" AS VARCHAR) AS "Rank" FROM ({J.RANKED_SQL})""")
def g6_formatted_tab(spark, sf):
    at = _allocated(spark, sf)
    for _ in (1, 2):
        S.sync_backend_predictions(spark, at, "one")
    S.publish_formatted(spark, at)
    return _tab(spark, at.formatted)


CLEAN = [*J.REQUEST_COLUMNS, "Skills"]


@query(_cells_sql(CLEAN, J.CLEAN_SQL))
def g7_clean_csv(spark, sf):
    at = _places(S.RequestSheets, spark)
    write_tab(J.raw_requests(spark, sf), at.requests, order=ORDER)
    S.publish_clean(spark, at)
    return _tab(spark, at.clean_csv[0])


def _requests_done(spark, sf):
    """The whole chain, started twice as one run: the second start finds every stage done."""
    at = _places(S.RequestSheets, spark)
    write_tab(J.raw_requests(spark, sf), at.requests, order=ORDER)
    write_tab(J._requests(spark, sf, J.OLD_WHERE), at.old, order=ORDER)
    write_tab(J._requests(spark, sf, J.MAIN_WHERE).drop(ORDER), at.main)
    write_tab(J.generic_jobs(spark, sf), at.generic, order=ORDER)
    for _ in (1, 2):
        S.requests_job(spark, at, f"{at.main}-manifest", "run")
    return at


@query(f"""WITH c AS ({J.CLEAN_SQL}), u AS (
         SELECT "Request Name", "Job Title", price, 0 AS src, _ord, 'Old VRF ID' AS status FROM ({J._requests_sql(J.OLD_WHERE)})
         UNION ALL SELECT "Request Name", "Job Title", NULL, 1, 0, 'New VRF ID' FROM c),
       m AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY "Request Name" ORDER BY src DESC, _ord DESC) = 1)
       SELECT "Request Name", "Job Title", price, status AS "VRF ID Status" FROM m
       UNION ALL SELECT "Request Name", "Job Title", price, NULL FROM ({J._requests_sql(J.MAIN_WHERE)})
       WHERE "Request Name" NOT IN (SELECT "Request Name" FROM m WHERE "Request Name" IS NOT NULL)""")
def g8_requests_chain(spark, sf):
    main = _tab(spark, _requests_done(spark, sf).main)
    return main.select("Request Name", "Job Title", F.col("price").cast("double").alias("price"), "VRF ID Status")
