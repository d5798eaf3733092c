"""Projections between the zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.contracts import INTERMEDIATE
from cairn.functions import values as v


def flatten(valid: DataFrame) -> DataFrame:
    """Validated records to the intermediate columns."""
    return valid.select(
        F.col("name.common").alias("country_name"),
        v.blank_to_null(F.col("region")).alias("region"),
        "subregion",
        v.whole_number(F.col("population")).alias("population"),
        v.number(F.col("area")).alias("area"),
        v.first_or_blank(F.col("capital")).alias("capital_city"),
        v.canonical_json(F.col("currencies")).alias("currency"),
    )


def curate(intermediate: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """The curated columns: the intermediate ones in their order, and the load date."""
    return intermediate.select(*INTERMEDIATE.fieldNames(), v.load_date(run_date).alias("load_date"))


def with_density(df: DataFrame) -> DataFrame:
    return df.withColumn("population_density", v.density(F.col("population"), F.col("area")))


def enrich(valid: DataFrame) -> DataFrame:
    """The documented wide projection: official name, first currency and stored density."""
    flat = valid.select(
        F.col("name.common").alias("country_name"),
        F.col("name.official").alias("official_name"),
        v.blank_to_null(F.col("region")).alias("region"),
        "subregion",
        v.whole_number(F.col("population")).alias("population"),
        v.number(F.col("area")).alias("area"),
        v.first_or_blank(F.col("capital")).alias("capital"),
        v.first_key(F.col("currencies")).alias("currency_code"),
        v.first_currency_name(F.col("currencies")).alias("currency_name"),
    )
    return with_density(flat)


def local_projection(valid: DataFrame) -> DataFrame:
    """The local run's four columns."""
    return valid.select(
        F.col("name.common").alias("country_name"),
        v.blank_to_null(F.col("region")).alias("region"),
        v.whole_number(F.col("population")).alias("population"),
        v.first_currency_name(F.col("currencies")).alias("currency_name"),
    )
