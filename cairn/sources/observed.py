"""What the landed records actually contain: fields, types, presence."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.workspace import scratch_path


def observed_fields(records: DataFrame) -> DataFrame:
    """Each top-level field name with the number of records that carry it, NULL values included."""
    names = records.select(F.explode(F.array_distinct(F.json_object_keys("record"))).alias("field"))
    return names.groupBy("field").agg(F.count("*").alias("n_records"))


def observed_schema(records: DataFrame) -> DataFrame:
    """One row: the type that holds every record, as Spark type text."""
    return records.agg(F.schema_of_variant_agg(F.try_parse_json("record")).alias("schema"))


#: Marks the elements of an array in a path.
ELEMENT = "[]"


def observed_types(records: DataFrame, map_like: Iterable[str] = ("currencies",)) -> DataFrame:
    """``path``, ``ancestors``, ``type`` and ``n_values``: each type that values have at each path, to any depth.

    Level by level, the members of objects (``a.b``) and the elements of arrays (``a[]``) are taken apart and counted by
    path and type, until no object or array is left; what goes down a level is written, so no level is parsed twice. The
    keys of ``map_like`` paths are data, not fields: they alone are not followed, so the result stays as small as the
    contract. Types are VARIANT's, without their digits and members; a null is ``VOID``, as is a record that is no JSON.
    Objects that repeat a member are no VARIANT. A record that is an object itself has no row of its own.
    """
    map_like = tuple(map_like)
    level = records.select(F.lit("").alias("path"), F.array().cast("array<string>").alias("ancestors"), F.explode(F.array(F.try_parse_json("record"))).alias("value"))
    counts: list[DataFrame] = []
    while True:
        followed = F.col("type").isin("OBJECT", "ARRAY") & ~((F.col("type") == "OBJECT") & F.col("path").isin(*map_like))
        typed = level.withColumn("type", _kind("value"))
        staged = _staged(typed.select("path", "ancestors", "type", F.when(followed, F.col("value")).alias("value")), "types")
        counts.append(staged.groupBy("path", "ancestors", "type").agg(F.count(F.lit(1)).alias("n_values")))
        containers = staged.where("value IS NOT NULL")
        if containers.isEmpty():
            break
        value = F.col("value")
        # objects as maps and arrays as entries without a name: one generator for both
        entries = F.when(F.col("type") == "OBJECT", F.map_entries(value.try_cast("MAP<STRING, VARIANT>"))).otherwise(
            F.transform(value.try_cast("ARRAY<VARIANT>"), lambda item: F.struct(F.lit(None).cast("string").alias("key"), item.alias("value")))
        )
        below = containers.select("path", "ancestors", F.explode(entries).alias("entry"))
        dotted = F.concat(F.when(F.col("path") == "", F.lit("")).otherwise(F.concat("path", F.lit("."))), F.col("entry.key"))
        level = below.select(
            F.coalesce(dotted, F.concat("path", F.lit(ELEMENT))).alias("path"),
            F.when(F.col("path") == "", F.col("ancestors")).otherwise(F.array_append("ancestors", F.col("path"))).alias("ancestors"),
            F.col("entry.value").alias("value"),
        )
    found = functools.reduce(DataFrame.unionByName, counts)
    return found.where("path <> '' OR type <> 'OBJECT'")


def _kind(value: str) -> Column:
    return F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), "^[A-Z_]+", 0)


SHREDDING = "spark.sql.variant.inferShreddingSchema"


def _staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written and read back. Values stay as they are: laid out by member, a file would give numbers of one path one type."""
    spark = df.sparkSession
    path, before = scratch_path(spark, purpose), spark.conf.get(SHREDDING, None)
    spark.conf.set(SHREDDING, "false")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHREDDING) if before is None else spark.conf.set(SHREDDING, before)
    return spark.read.schema(df.schema).parquet(path)


#: Kinds of whole numbers, and of numbers that may have a fraction.
WHOLE, FRACTIONAL = ("TINYINT", "SMALLINT", "INT", "BIGINT"), ("DECIMAL", "FLOAT", "DOUBLE")


def widened_types(types: DataFrame) -> DataFrame:
    """``path`` and ``type``: the one type that holds all values at each path of ``observed_types``.

    Nulls fit any type; alone they are ``STRING``. Whole numbers and fractions meet in ``DOUBLE``. Any other two kinds meet
    only as text: the path is ``STRING``, and what lay below it is gone.
    """
    kind = F.when(F.col("type").isin(*WHOLE), "BIGINT").when(F.col("type").isin(*FRACTIONAL), "DOUBLE").otherwise(F.col("type"))
    kinds = F.array_sort(F.collect_set(F.when(F.col("type") != "VOID", kind)))
    merged = types.groupBy("path", "ancestors").agg(kinds.alias("kinds"))
    numbers = F.size(F.array_except("kinds", F.array(F.lit("BIGINT"), F.lit("DOUBLE")))) == 0
    one = F.when(F.size("kinds") == 1, F.col("kinds")[0]).when((F.size("kinds") > 1) & numbers, F.lit("DOUBLE")).otherwise(F.lit("STRING"))
    named = merged.select("path", "ancestors", one.alias("type"), (F.size("kinds") > 0).alias("known"))
    # a text has nothing below it
    texts = named.where("type = 'STRING' AND known").select(F.col("path").alias("text"))
    below = named.select("path", F.explode("ancestors").alias("text")).join(texts, "text").select("path").distinct()
    return named.join(below, "path", "left_anti").select("path", "type")


def carrying(keys: str, fields: Iterable[str]) -> list[Column]:
    """Aggregates over the keys of records: how many carry each field, as ``n0``, ``n1`` and so on."""
    return [F.count_if(F.array_contains(keys, name)).alias(f"n{i}") for i, name in enumerate(fields)]


def field_presence(records: DataFrame, fields: Iterable[str]) -> DataFrame:
    """One row per asked field: how many records carry it, and whether any does."""
    fields = list(fields)
    counts = records.select(F.json_object_keys("record").alias("keys")).agg(*carrying("keys", fields))
    rows = F.array(*[F.struct(F.lit(name).alias("field"), F.col(f"n{i}").alias("n_records")) for i, name in enumerate(fields)])
    return counts.select(F.inline(rows)).withColumn("present", F.col("n_records") > 0)


def missing_fields(records: DataFrame, required: Iterable[str]) -> list[str]:
    """The required fields no record carries, in one pass."""
    return [row["field"] for row in field_presence(records, required).where(~F.col("present")).collect()]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """``df`` itself, or ValueError naming every required column it lacks."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def dotted_columns(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
    """One column per leaf of nested structs, named by its dotted path. Arrays and maps are leaves."""
    columns = []
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            columns += dotted_columns(field.dataType, here)
        else:
            columns.append(F.col(".".join(f"`{part}`" for part in here)).alias(".".join(here)))
    return columns


def flatten_dotted(df: DataFrame) -> DataFrame:
    return df.select(*dotted_columns(df.schema))
