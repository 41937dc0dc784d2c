"""Parquet table source for the star-schema input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(base_dir: str, name: str) -> str:
    return f"{base_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(base_dir, name))
