"""Column contracts of the zones.

Every read states its schema, so an empty zone, a field no record carries or a region
that looks like a number never changes a type.
"""

from __future__ import annotations

from pyspark.sql import types as T

NAME = T.StructType([T.StructField("common", T.StringType()), T.StructField("official", T.StringType())])
# Members of a currency are whatever the document has: all of them reach its text.
CURRENCY = T.VariantType()

# population and area stay text until they are cast: a single bad number must cost one
# value, not the record and not the file it came in.
RAW = T.StructType(
    [
        T.StructField("name", NAME),
        T.StructField("region", T.StringType()),
        T.StructField("subregion", T.StringType()),
        T.StructField("population", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("capital", T.ArrayType(T.StringType())),
        T.StructField("currencies", T.MapType(T.StringType(), CURRENCY)),
    ]
)
RAW_COLUMNS = RAW.fieldNames()

# The same for input known to be well typed. The decimal holds every BIGINT and a fraction.
NUMBERS = {"population": T.DecimalType(38, 6), "area": T.DoubleType()}
TRUSTED = T.StructType([T.StructField(field.name, NUMBERS.get(field.name, field.dataType)) for field in RAW.fields])

CORRUPT = "_corrupt_record"
RECORDS = T.StructType([T.StructField("record", T.StringType()), T.StructField("file_path", T.StringType())])

REQUIRED_FIELDS = ("name", "population", "region")

# The validated zone holds both outcomes of validation, one partition level per outcome.
VALID, REJECTED = "valid", "rejected"
CHECKED = T.StructType(
    [
        *RAW.fields,
        T.StructField("record", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("verdict", T.StringType()),
    ]
)

INTERMEDIATE = T.StructType(
    [
        T.StructField("country_name", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("subregion", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("area", T.DoubleType()),
        T.StructField("capital_city", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)
CURATED = T.StructType([*INTERMEDIATE.fields, T.StructField("load_date", T.DateType())])

RUN_AUDIT = T.StructType(
    [
        T.StructField("run_ts", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_valid", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("files_archived", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("source_status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# Rows that broke each rule, for every stage that applies rules.
RUN_QUALITY = T.StructType(
    [
        *(T.StructField(name, T.StringType()) for name in ("run_ts", "stage", "rule")),
        T.StructField("n_rows", T.LongType()),
    ]
)

# Planned and made moves of raw files.
MOVES = T.StructType([T.StructField(name, T.StringType()) for name in ("path", "archive_path")])
