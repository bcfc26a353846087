"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One parquet table under ``base_dir``; columns are pruned by the plan."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
