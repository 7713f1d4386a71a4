"""Loading the given parquet tables.

Only a path and (optionally) the columns needed are given: Catalyst prunes the
``ReadSchema`` to those columns and pushes filters written later into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events")
