"""Reading the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
