"""SQL over named tables, their listing, and their rows as records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.columns import col
from rollmatch.functions.jsontext import row_json


def publish_view(df: DataFrame, name: str) -> None:
    """Make a table readable by SQL in this session, replacing one of that name."""
    df.createOrReplaceTempView(name)


def save_sql_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Write a table of that name, replacing what it held."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(name)


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    return spark.sql(text, args=dict(args)) if args else spark.sql(text)


def table_names(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def column_names(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table)]


def cells(spark: SparkSession, table: str, key: str) -> DataFrame:
    """Each row's columns as (key, position, name, value) rows, named and placed by the table's column listing."""
    names = column_names(spark, table)
    listed = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("name"), col(n).cast("string").alias("value"))
        for i, n in enumerate(names)
    ])
    rows = spark.table(table).select(col(key).alias("record"), F.explode(listed).alias("c"))
    return rows.select("record", "c.position", "c.name", "c.value")


def records(spark: SparkSession, table: str) -> DataFrame:
    """Every row of a table as one JSON record."""
    df = spark.table(table)
    return df.select(row_json(df.columns).alias("record"))


