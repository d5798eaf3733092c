"""Raw zone readers: JSON files to one row per record, and records to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.contracts import CORRUPT, RAW, RAW_COLUMNS, TRUSTED
from cairn.functions.values import unique_keys

WHITESPACE = " \t\r\n"

# How the files of a raw zone hold their records.
#   lines     one record per line; splits at any line.
#   indented  one array per file, as written with an indent of two. The text between two
#             records is the line separator, so one huge file is read by many tasks. It cannot
#             occur inside a record: JSON strings hold no line breaks and nested objects are
#             indented further. A file written another way is one piece and parses the same.
#   whole     one array per file, the file as one piece: one bad byte rejects the whole file.
LAYOUTS = {
    "lines": {},
    "indented": {"lineSep": "\n  {\n"},
    "whole": {"wholetext": "true"},
}


def read_texts(spark: SparkSession, path: str, layout: str = "lines", stream_options: dict | None = None) -> DataFrame:
    """``value`` and ``file_path`` of every piece of text below ``path``; a stream when options for one are given."""
    if stream_options is None:
        # as the archive's listing goes: folders inside folders belong to the zone
        reader = spark.read.option("recursiveFileLookup", True)
    else:
        reader = spark.readStream.options(**stream_options)
    texts = reader.format("text").options(**LAYOUTS[layout]).load(path)
    return texts.select("value", F.col("_metadata.file_path").alias("file_path"))


def lines_to_records(texts: DataFrame) -> DataFrame:
    """One record per non-blank line, as it was before ``record_line``."""
    value = F.col("value")
    unpacked = F.get(F.from_json(F.concat(F.lit("["), value, F.lit("]")), T.ArrayType(T.StringType())), F.lit(0))
    record = F.when(value.startswith('"'), F.coalesce(unpacked, value)).when(value != "null", value)
    return texts.where(F.ltrim("value", F.lit(WHITESPACE)) != "").select(record.alias("record"), "file_path")


def record_line(record: Column) -> Column:
    """A record as one line of text that ``lines_to_records`` turns into the record again.

    A line break inside valid JSON can only be white space. Any other text, cut or blank, becomes a
    JSON string; NULL becomes ``null``.
    """
    packed = F.to_json(F.array(record))
    literal = F.substr(packed, F.lit(2), F.length(packed) - 2)
    broken = F.contains(record, F.lit("\n")) | F.contains(record, F.lit("\r"))
    plain = F.when(~broken, record).when(is_one_value(record, "{", "}"), F.translate(record, "\r\n", "  "))
    is_object = F.ltrim(record, F.lit(WHITESPACE)).startswith("{")
    return F.when(record.isNull(), F.lit("null")).otherwise(F.coalesce(F.when(is_object, plain), literal))


def is_one_value(text: Column, opening: str, closing: str) -> Column:
    """Whether a text is exactly one JSON object (or array), without anything behind it."""
    trimmed = F.trim(text, F.lit(WHITESPACE))
    single = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(trimmed.startswith(opening) & trimmed.endswith(closing) & single, F.lit(False))


def arrays_to_records(texts: DataFrame, layout: str = "indented") -> DataFrame:
    """One record per array element, from whole arrays or from the pieces of an indented one.

    Keys keep their order and integers their digits. Text that is no array becomes one record,
    which no contract accepts, so it reaches the rejected rows with its content.
    """
    array_text = F.col("value") if layout == "whole" else _piece_as_array(F.col("value"))
    elements = F.from_json(F.when(is_one_value(array_text, "[", "]"), array_text), T.ArrayType(T.StringType()))
    unreadable = F.array(F.col("value"))
    return texts.select(F.explode(F.coalesce(elements, unreadable)).alias("record"), "file_path")


def _piece_as_array(piece: Column) -> Column:
    """A piece of an indented array file as an array of its own.

    A piece lacks the ``[{`` that the separator before it swallowed and, unless it is the file's
    last, ends in the comma before the next one. A record cut short stays unbalanced and fails to parse.
    """
    is_head = F.ltrim(piece, F.lit(WHITESPACE)).startswith("[")
    opened = F.when(is_head, piece).otherwise(F.concat(F.lit("[{"), piece))
    is_inner = piece.endswith(",")
    without_comma = F.substr(opened, F.lit(1), F.length(opened) - 1)
    only_bracket = F.trim(piece, F.lit(WHITESPACE)) == "["
    return F.when(is_inner, F.concat(without_comma, F.lit("]"))).when(only_bracket, F.lit("[]")).otherwise(opened)


def read_records(spark: SparkSession, path: str, layout: str = "lines", stream_options: dict | None = None) -> DataFrame:
    """``record`` and ``file_path`` of every record below ``path``, duplicates included."""
    texts = read_texts(spark, path, layout, stream_options)
    return lines_to_records(texts) if layout == "lines" else arrays_to_records(texts, layout)


def parse_records(records: DataFrame) -> DataFrame:
    """The RAW columns of each record, its text, and ``_corrupt_record`` where it breaks the contract.

    Parsing record by record means a bad one costs itself only; its columns are NULL, as are
    fields that no record carries.
    """
    contract = T.StructType([*RAW.fields, T.StructField(CORRUPT, T.StringType())])
    # from_json would quietly take the first element of an array, and drop what follows an object.
    is_object = is_one_value(F.col("record"), "{", "}")
    parsed = F.from_json(F.when(F.col("is_object"), F.col("record")), contract, {"columnNameOfCorruptRecord": CORRUPT})
    # A generator, because filters are not pushed through one: as a projection, the parse would be
    # copied into a later filter once per column the filter looks at.
    staged = records.withColumn("is_object", is_object).select("record", "file_path", "is_object", F.inline(F.array(parsed)))
    corrupt = F.when(F.col("is_object"), F.col(CORRUPT)).otherwise(F.coalesce("record", F.lit("null")))
    readable = F.col("is_object") & F.col(CORRUPT).isNull()
    fields = {name: F.col(name) for name in RAW_COLUMNS}
    fields["currencies"] = unique_keys(fields["currencies"])
    return staged.select(
        *[F.when(readable, field).alias(name) for name, field in fields.items()],
        "record",
        "file_path",
        corrupt.alias(CORRUPT),
    )


def scan_arrays(spark: SparkSession, path: str) -> DataFrame:
    """Typed scan of trusted array files. One wrong type rejects the whole file; see ``read_records``.

    Numbers are read as numbers: for a number wanted as text the reader goes back to the file
    once per value.
    """
    return spark.read.schema(TRUSTED).option("multiLine", True).json(path)


def to_records(df: DataFrame) -> DataFrame:
    """Rows as JSON records, for landing columnar input."""
    return df.select(F.to_json(F.struct("*")).alias("record"))
