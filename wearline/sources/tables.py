"""Readers for the parquet tables a fleet is built from.

Readers select only the columns a view needs, so the parquet scan's
``ReadSchema`` carries just those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
