import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from edge_cases import SCHEMA, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The edge cases as a table of several files."""
    path = str(tmp_path_factory.mktemp("edge") / "documents")
    spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
