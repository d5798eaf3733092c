"""Aggregate and ranking reports over the curated table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.transforms import with_density

TOP_K_COLUMNS = ("country_name", "region", "subregion", "population", "area", "population_density")


def group_report(df: DataFrame, key: str, measure: str, counted: str) -> DataFrame:
    """Sum, row count, mean to two digits, maximum and minimum of an integer measure, largest sum first.

    The mean is the exact sum over the count: adding doubles would make its last digits depend
    on how the rows were partitioned. A NULL key is a group of its own.
    """
    total = F.sum(measure)
    return (
        df.groupBy(key)
        .agg(
            total.alias(f"total_{measure}"),
            F.count("*").alias(f"{counted}_count"),
            F.round(total / F.count(measure), 2).alias(f"avg_{measure}"),
            F.max(measure).alias(f"max_{measure}"),
            F.min(measure).alias(f"min_{measure}"),
        )
        .orderBy(F.desc_nulls_last(f"total_{measure}"), F.asc_nulls_last(key))
    )


def region_report(curated: DataFrame) -> DataFrame:
    return group_report(curated, "region", "population", "country")


def region_sum(curated: DataFrame) -> DataFrame:
    """Total population per region, in no order."""
    return curated.groupBy("region").agg(F.sum("population").alias("total_population"))


def region_sum_count(curated: DataFrame) -> DataFrame:
    """Total population and number of countries per region, largest first."""
    sums = curated.groupBy("region").agg(F.sum("population").alias("total_population"), F.count("*").alias("countries"))
    return sums.orderBy(F.desc_nulls_last("total_population"), F.asc_nulls_last("region"))


def top_k_report(curated: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most populous rows with their density. Ties fall to the other columns, so runs agree.

    Sort and limit plan as one top-k: each task keeps ``k`` rows and nothing is fully sorted.
    """
    ties = [F.asc_nulls_last(name) for name in ("country_name", "region", "subregion", "area")]
    ranked = curated.orderBy(F.desc_nulls_last("population"), *ties).limit(k)
    return with_density(ranked).select(*TOP_K_COLUMNS)


def run_report_sql(spark: SparkSession, text: str, curated: DataFrame) -> DataFrame:
    """A SQL report over the table written ``{curated}`` in its text."""
    return spark.sql(text, curated=curated)
