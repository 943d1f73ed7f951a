"""Parquet table access with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """Read one driver table; selecting ``columns`` up front keeps the
    Parquet ``ReadSchema`` to what the query uses."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
