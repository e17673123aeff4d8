"""Table scans: one Parquet data set per table under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table; columns and filters chosen later reach the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
