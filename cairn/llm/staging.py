"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cairn.workspace import scratch_path


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back, so that nothing above it runs again."""
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
