"""Files as rows, and the choice between landed data and a stand-in."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``n_bytes`` of every file below ``path``; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select("path", F.col("length").alias("n_bytes"))


def landed_sizes(texts: DataFrame, by: str = "file_path") -> DataFrame:
    """Records and payload bytes of each landed file (or of another grouping of the texts)."""
    return texts.groupBy(by).agg(F.count("*").alias("n_records"), F.sum(F.octet_length("value")).alias("n_bytes"))


def has_landed(spark: SparkSession, zone: str, run_ts: str | None = None) -> bool:
    """Whether the zone holds a file with content, or the given run's folder, be it empty.

    A run that landed no record is data, not its absence.
    """
    try:
        if run_ts is not None and _is_readable(spark, f"{zone}/run_ts={run_ts}"):
            return True
        return not list_files(spark, zone).isEmpty()
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _is_readable(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path)
    except AnalysisException as failure:
        if failure.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def source_or_fallback(primary: DataFrame | None, fallback: DataFrame | None = None) -> DataFrame:
    """The primary source, or the fallback when it is absent (None), with ``source_status`` saying which.

    There is no fallback unless the caller passes one: stand-in rows must not pass for real ones unasked.
    """
    if primary is not None:
        return primary.withColumn("source_status", F.lit("success"))
    if fallback is None:
        raise ValueError("nothing landed and no fallback given")
    return fallback.withColumn("source_status", F.lit("fallback"))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none where there is no folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in filesystem.listStatus(folder)] if filesystem.exists(folder) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that the library made, with what is in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
