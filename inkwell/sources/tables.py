"""Named Parquet tables of one data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """The table ``name`` of ``data_dir``: one Parquet file or a folder of them."""
    return spark.read.parquet(f"{data_dir}/{name}.parquet")
