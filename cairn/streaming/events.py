"""Status events as they land: normalised and appended, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cairn.operators.events import event_field, normalise_events

SCHEMA = "status string, stage string, message string, reason string, source string, executionArn string, timestamp string, job_name string, landed_in string"
DEFAULT_JOB = "unknown"


def read_event_stream(spark: SparkSession, landed: str, max_files: int | None = None) -> DataFrame:
    """``body`` and the file it landed in, one row for each line of the files that come into a folder; blank lines are none."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    texts = reader.load(landed).select(F.col("value").alias("body"), F.col("_metadata.file_name").alias("landed_in"))
    return texts.where(F.trim("body") != "")


def normalised(messages: DataFrame, body: str = "body", default_job: str = DEFAULT_JOB) -> DataFrame:
    """The fields of status messages and the job each is about. Row by row, so a batch and a stream give the same."""
    return normalise_events(event_field(messages.withColumn("_message", F.col(body)), "_message", "job_name", default_job).drop("_message"), body)


def run_event_stream(
    spark: SparkSession, landed: str, target: str, checkpoint: str, max_files: int | None = None, default_job: str = DEFAULT_JOB
) -> StreamingQuery:
    """Appends the events that no earlier run with this checkpoint has seen, and ends; the ended query comes back.

    The Parquet sink keeps a log of its own, so an event of a batch that is repeated after a failure is there once.
    """
    events = normalised(read_event_stream(spark, landed, max_files), default_job=default_job)
    writer = events.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    query = writer.outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
