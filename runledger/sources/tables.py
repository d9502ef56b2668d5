"""Parquet tables as DataFrames and views."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as it is now, schema and files."""
    return spark.read.parquet(table_path(folder, name))


def register_views(
    spark: SparkSession, folder: str, names: Iterable[str] = TABLES
) -> None:
    """Make the named tables visible to SQL text under their own names."""
    for name in names:
        read_table(spark, folder, name).createOrReplaceTempView(name)
