"""Parquet tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Some columns of a Parquet table; how it is split is for the session's reader settings."""
    return spark.read.parquet(path).select(*columns)
