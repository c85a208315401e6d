"""Readers for the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read `<sf_dir>/<name>.parquet`, a file or a folder, by Spark's reader alone."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
