"""Writers: Parquet zones, landed records, materialised results and the run audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cairn.contracts import RUN_AUDIT, RUN_QUALITY
from cairn.functions.paths import split_filesystem
from cairn.sources.records import record_line


PARTITIONS = "partitions written"


class EmptyZone(ValueError):
    """There was nothing to write, and the caller wanted the old content kept."""


@dataclass(frozen=True)
class ZoneWrite:
    path: str
    written: bool = True
    metrics: dict[str, int] = field(default_factory=dict)
    partitions: list[dict[str, str | None]] | None = None


def input_roots(df: DataFrame) -> list[str]:
    """The paths a frame reads from, as they were given to its readers: a handful, however many files there are."""
    leaves, roots = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        if leaves.apply(i).getClass().getSimpleName() == "LogicalRelation":
            relation = leaves.apply(i).relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                paths = relation.location().rootPaths()
                roots += [paths.apply(j).toString() for j in range(paths.size())]
    return roots


def overlapping(one: str, other: str) -> bool:
    """Whether one path is the other or lies inside it."""
    inner, outer = (split_filesystem(path)[1].rstrip("/") + "/" for path in (one, other))
    return inner.startswith(outer) or outer.startswith(inner)


def write_zone(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | str | None = ("region",),
    *,
    layout: str = "rebalance",
    mode: str = "overwrite",
    partition_overwrite: str = "static",
    on_empty: str = "write",
    compression: str = "snappy",
    metrics: dict[str, Column] | None = None,
    check_inputs: bool = True,
    report_partitions: bool = False,
) -> ZoneWrite:
    """Writes a Parquet zone and returns counts taken on the way.

    layout  ``rebalance`` shuffles rows to their partitions so that a partition is a few files
            of the advisory size. The adaptive planner cuts a hot partition over many tasks and
            joins small ones; no task gets a whole one. ``inherit`` writes without a shuffle,
            for input that is already laid out by partition, such as another zone.
    partition_overwrite  ``static`` replaces the zone, ``dynamic`` only the partitions written.
    on_empty  ``write`` empties the zone, ``fail`` raises and ``skip`` returns, both leaving it as
            it was. The test stops at the first row.
    metrics  Aggregates observed in the writing tasks. They sit after the shuffle, in the last
            stage, where a task that is run again is counted once.
    check_inputs  Refuses to overwrite files the frame reads: Spark deletes them first.
    report_partitions  Returns the partitions that rows were written to, observed on the way: no folder is listed. The
            catalog is told of each of them, so their number is what a driver bears.
    """
    if check_inputs and mode == "overwrite" and any(overlapping(root, path) for root in input_roots(df)):
        raise ValueError(f"{path} is read by the frame that is to overwrite it")
    if on_empty != "write" and df.isEmpty():
        if on_empty == "fail":
            raise EmptyZone(f"no rows for {path}")
        return ZoneWrite(path, written=False)

    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if layout == "rebalance":
        df = df.hint("rebalance", *columns)
    observed = dict(metrics or {})
    if report_partitions and columns:
        observed[PARTITIONS] = F.collect_set(F.struct(*[F.col(name).cast("string").alias(name) for name in columns]))
    observation = Observation() if observed else None
    if observation:
        df = df.observe(observation, *[column.alias(name) for name, column in observed.items()])
    writer = df.write.mode(mode).option("compression", compression).option("partitionOverwriteMode", partition_overwrite)
    if columns:
        writer = writer.partitionBy(*columns)
    writer.parquet(path)
    found = dict(observation.get) if observation else {}
    partitions = found.pop(PARTITIONS, None)
    # a blank value reads back as NULL, and has its folder with it
    made = {tuple(row[name] or None for name in columns) for row in partitions} if partitions is not None else None
    made = made if made is None else [dict(zip(columns, values, strict=True)) for values in sorted(made, key=repr)]
    return ZoneWrite(path, metrics=found, partitions=made)


def land(records: DataFrame, zone: str, run_ts: str, compression: str | None = None) -> ZoneWrite:
    """Lands ``record`` texts as JSON Lines in the run's own folder, which must not exist yet.

    One line for each record, whatever its text, lets any number of tasks read the zone. A run without records still
    leaves a file, so "nothing came" and "an empty answer came" stay apart.
    """
    path = f"{zone.rstrip('/')}/run_ts={run_ts}"
    observation = Observation()
    texts = records.select(record_line(F.col("record")).alias("value")).observe(
        observation,
        F.count(F.lit(1)).alias("rows_in"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("n_bytes"),
    )
    writer = texts.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).text(path)
    return ZoneWrite(path, metrics=observation.get)


def materialize(df: DataFrame, path: str, fmt: str = "csv", **options) -> str:
    """Stores a query result; CSV with a header unless told otherwise."""
    if fmt == "csv":
        options = {"header": True} | options
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def append_audit(spark: SparkSession, audit: str, **facts) -> None:
    """Appends one row about a stage of a run."""
    row = tuple(facts.get(name) for name in RUN_AUDIT.fieldNames())
    spark.createDataFrame([row], RUN_AUDIT).coalesce(1).write.mode("append").parquet(audit)


def append_quality(spark: SparkSession, quality: str, run_ts: str, stage: str, broken: dict[str, int]) -> None:
    """Appends one row for each rule of a stage: how many rows broke it."""
    rows = [(run_ts, stage, rule, count) for rule, count in broken.items()]
    spark.createDataFrame(rows, RUN_QUALITY).coalesce(1).write.mode("append").parquet(quality)


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_QUALITY).parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_AUDIT).parquet(path)
