"""Managed tables, views and databases."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def create_namespace(spark: SparkSession, name: str) -> None:
    """S4."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def empty_table(spark: SparkSession, name: str) -> None:
    """Drop the rows before a full reload, if the table exists."""
    if spark.catalog.tableExists(name):
        spark.sql(f"TRUNCATE TABLE {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S7."""
    return spark.table(name)


def read_database(
    spark: SparkSession, url: str, query: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """The result of a query the database runs.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` with ``dbtable`` in ``options`` for a parallel read.
    """
    options = dict(options or {})
    reader = spark.read.format("jdbc").option("url", url)
    if "dbtable" not in options:
        reader = reader.option("query", query)
    return reader.options(**options).load()


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: tuple[str, ...] = (),
    cluster_by: str | None = None,
    fmt: str = "parquet",
) -> None:
    """Create the table from a query, or put its result in place of the old one.

    ``cluster_by`` sorts inside files, so scans for one key skip row groups.
    """
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, cluster_by)
    writer = df.write.format(fmt).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Add rows to a table."""
    df.write.format(fmt).mode("append").saveAsTable(name)


def drop_and_create(df: DataFrame, name: str) -> None:
    """S8."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.saveAsTable(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A view of the query's result under a name for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
