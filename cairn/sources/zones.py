"""Readers of the Parquet zones and of catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.contracts import CHECKED, CURATED, INTERMEDIATE, RAW_COLUMNS, REJECTED, VALID


def read_zone(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A zone in its contract's column order. The stated schema keeps region text, and an empty zone readable."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_valid(spark: SparkSession, path: str) -> DataFrame:
    """Valid records of the validated zone; the other partition is not read."""
    return read_zone(spark, path, CHECKED).where(F.col("verdict") == VALID).select(*RAW_COLUMNS)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """Rejected records with their text, their file and the rules they break."""
    return read_zone(spark, path, CHECKED).where(F.col("verdict") == REJECTED).drop("verdict")


def read_intermediate(spark: SparkSession, path: str) -> DataFrame:
    return read_zone(spark, path, INTERMEDIATE)


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    return read_zone(spark, path, CURATED)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")
