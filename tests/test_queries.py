"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import check, database

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    message, _, good = check(spark, con, name, SF, QUERIES, ORACLES)
    assert good, message


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["SP ID", "Job Title Prediction", "VRF ID", "Department", "Rank"]
