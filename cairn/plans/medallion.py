"""The batch run: land, validate, flatten, curate, register, report."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.contracts import CURATED, REQUIRED_FIELDS, VALID
from cairn.operators.archive import archive_files, finish_archives
from cairn.operators.catalog import (
    add_partitions,
    create_database,
    drop_versions,
    has_table,
    register_table,
    register_version,
    repair_table,
    switch_version,
    version_path,
)
from cairn.operators.reports import region_report, top_k_report
from cairn.operators.rules import FieldRule, Rule, check, contract_rules, folder_rule, rule_counts, validate, weak_rules
from cairn.operators.sinks import EmptyZone, ZoneWrite, append_audit, append_quality, land, materialize, overlapping, write_zone
from cairn.operators.transforms import curate, flatten, local_projection
from cairn.sources.files import has_landed, list_files, source_or_fallback
from cairn.sources.observed import carrying
from cairn.sources.records import arrays_to_records, parse_records, read_records
from cairn.sources.zones import read_curated, read_intermediate, read_table, read_valid


def new_run_ts() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")


@dataclass(frozen=True)
class Run:
    """Where a run reads and writes, and the choices the caller makes for it.

    replacement  ``in_place`` overwrites the curated zone. ``versioned`` writes a folder of its own, which the table's
                 name shows from one moment to the next when all is written; ``keep_versions`` earlier ones stay.
    """

    root: str
    run_ts: str = field(default_factory=new_run_ts)
    run_date: dt.date | None = None
    dataset: str = "records"
    raw_layout: str = "lines"
    raw_suffix: str = ""
    required: tuple[str, ...] = REQUIRED_FIELDS
    population_min: float | None = 0
    allow_nulls: bool = False
    on_empty: str = "fail"
    partition_overwrite: str = "static"
    replacement: str = "in_place"
    keep_versions: int = 1
    validated_layout: str = "rebalance"
    keep_intermediate: bool = True
    archive_raw: bool = True
    database: str | None = None
    table: str = "records_curated"
    top_k: int = 50

    def __post_init__(self):
        if self.on_empty not in ("write", "fail", "skip"):
            raise ValueError(f"on_empty: {self.on_empty}")
        if self.replacement not in ("in_place", "versioned") or (self.replacement == "versioned" and not self.database):
            raise ValueError(f"replacement: {self.replacement}; versions need a database")
        for one, other in itertools.combinations(self.zones.values(), 2):
            if overlapping(one, other):
                raise ValueError(f"zones overlap: {one} and {other}")

    @property
    def zones(self) -> dict[str, str]:
        names = ("raw", "archive", "validated", "intermediate", "curated", "results")
        return {name: f"{self.root.rstrip('/')}/{name}/{self.dataset}" for name in names}

    @property
    def curated(self) -> str:
        """Where this run's curated rows lie."""
        zone = self.zones["curated"]
        return version_path(zone, self.run_ts) if self.replacement == "versioned" else zone

    @property
    def audit(self) -> str:
        return f"{self.root.rstrip('/')}/logs/run_audit"

    @property
    def quality(self) -> str:
        return f"{self.root.rstrip('/')}/logs/run_quality"

    @property
    def ledger(self) -> str:
        return f"{self.root.rstrip('/')}/logs/archived/{self.dataset}"


@dataclass(frozen=True)
class Stage:
    """What a stage did; its fields that the audit knows are recorded."""

    stage: str
    path: str | None = None
    status: str = "success"
    rows_in: int | None = None
    rows_valid: int | None = None
    rows_rejected: int | None = None
    files_archived: int | None = None
    n_bytes: int | None = None
    source_status: str | None = None
    broken: dict[str, int] | None = None
    partitions: list[dict[str, str | None]] | None = None


def audited(spark: SparkSession, run: Run, name: str, work: Callable[[], Stage]) -> Stage:
    """Runs a stage and appends its audit row, and one for each rule it applied; a failure is recorded and passed on, so
    later stages do not start."""
    try:
        done = work()
    except Exception as failure:
        append_audit(spark, run.audit, run_ts=run.run_ts, stage=name, status="failure", error=str(failure))
        raise
    if done.broken:
        append_quality(spark, run.quality, run.run_ts, done.stage, done.broken)
    append_audit(spark, run.audit, run_ts=run.run_ts, **vars(done))
    return done


def land_records(spark: SparkSession, run: Run, records: DataFrame | None, fallback: DataFrame | None = None) -> Stage:
    """Lands the records, or the fallback when there are none to be had (None), under the run's time."""
    chosen = source_or_fallback(records, fallback)
    landed = land(chosen.select("record"), run.zones["raw"], run.run_ts)
    return Stage("ingest", landed.path, source_status="fallback" if records is None else "success", **landed.metrics)


def payload_records(decoded: DataFrame) -> DataFrame:
    """Records of decoded payloads, each holding one array.

    A payload that did not decode is one record that says why, so it is rejected and counted.
    """
    failure = F.concat(F.lit("undecodable payload: "), F.coalesce("decode_error", F.lit("no text")))
    texts = decoded.select(F.coalesce("text", failure).alias("value"), F.lit(None).cast("string").alias("file_path"))
    return arrays_to_records(texts, "whole")


def run_rules(run: Run):
    return [*contract_rules(run.required, run.population_min, run.allow_nulls), folder_rule()]


BROKEN = "broken:"


def verdict_counts(rules: Sequence[Rule | FieldRule] = ()) -> dict[str, Column]:
    """What is observed of checked records while they are written: all, either verdict, and the breaks of each rule."""
    is_valid = F.col("verdict") == VALID
    counts = {"rows_in": F.count(F.lit(1)), "rows_valid": F.count_if(is_valid), "rows_rejected": F.count_if(~is_valid)}
    return counts | ({BROKEN + name: count for name, count in rule_counts(rules).items()} if rules else {})


def counted_stage(name: str, path: str, metrics: dict[str, int], **facts) -> Stage:
    """A stage's facts from what its write observed."""
    broken = {key.removeprefix(BROKEN): count for key, count in metrics.items() if key.startswith(BROKEN)}
    return Stage(name, path, broken=broken or None, **facts, **{key: count for key, count in metrics.items() if not key.startswith(BROKEN)})


FIRST_ROWS = 100


def gate(
    checked: DataFrame,
    required: Sequence[str],
    rules: Sequence[Rule | FieldRule],
    on_empty: str,
    target: str,
    counts: dict[str, int] | None = None,
    stored: bool = False,
) -> bool:
    """Whether to write checked records. Fails where no record carries a required field, and by ``on_empty`` where none is valid.

    Where a rule demands every required field, a valid row proves that they exist, so the usual run reads the first
    ``FIRST_ROWS`` of each task for this. Without such a row all records are read, once and by all tasks together, and
    ``counts`` is given their ``rows_in`` and ``rows_valid``. Looking for a valid row among all of them would read a few
    tasks' rows, then some more, and so on to the end. Only a ``stored`` zone, where the verdict is a folder, has that row at hand.
    """
    is_valid = F.col("verdict") == VALID
    proven = {f"{name}_required" for name in required} <= {rule.name for rule in rules}
    if proven:
        first = checked if stored else checked.limit(FIRST_ROWS)
        if not first.where(is_valid).isEmpty():
            return True
    totals = [F.count(F.lit(1)).alias("rows_in"), F.count_if(is_valid).alias("rows_valid")]
    found = checked.select("verdict", F.json_object_keys("record").alias("keys")).agg(*totals, *carrying("keys", required)).first()
    if counts is not None:
        counts.update(rows_in=found["rows_in"], rows_valid=found["rows_valid"])
    nothing_valid = found["rows_valid"] == 0
    absent = [name for i, name in enumerate(required) if found["rows_in"] and not found[f"n{i}"]]
    if absent and (nothing_valid or not proven):
        raise ValueError(f"missing required columns: {absent}")
    if nothing_valid and on_empty == "fail":
        raise EmptyZone(f"no valid rows for {target}")
    return not (nothing_valid and on_empty == "skip")


def write_checked(checked: DataFrame, path: str, partition_overwrite: str = "static", rules: Sequence[Rule | FieldRule] = (), **options) -> ZoneWrite:
    """Writes valid and rejected rows in one pass over the input, and counts both, and the rows that broke each rule.

    Rejected rows, whose region may be anything, share one folder; the record's text has their region.
    """
    checked = checked.withColumn("region", F.when(F.col("verdict") == VALID, F.col("region")))
    return write_zone(
        checked,
        path,
        ("verdict", "region"),
        metrics=verdict_counts(rules),
        partition_overwrite=partition_overwrite,
        check_inputs=False,
        **options,
    )


def validate_zone(spark: SparkSession, run: Run) -> Stage:
    """Raw zone to validated zone, then the raw files to the archive.

    Listing and read both take every file in the zone, folders inside folders included. The listing
    is taken before the read: a file that lands in between is read and stays for the next run. Files that an earlier run read and died before moving
    are moved first: read again, they would be all this run has, and replace what that run made.
    """
    raw, target = run.zones["raw"], run.zones["validated"]
    finish_archives(spark, run.ledger)
    files = list_files(spark, raw)
    rules = run_rules(run)
    checked = check(parse_records(read_records(spark, raw, run.raw_layout)), rules)

    if not gate(checked, run.required, rules, run.on_empty, target):
        return Stage("validate", target, status="skipped")

    written = write_checked(checked, target, run.partition_overwrite, rules, layout=run.validated_layout)
    archived = 0
    if run.archive_raw:
        archived = archive_files(files, raw, run.zones["archive"], run.ledger, run.run_ts, run.raw_suffix)
    return counted_stage("validate", target, written.metrics, files_archived=archived)


def _counted_write(df: DataFrame, path: str, run: Run, report_partitions: bool = False) -> ZoneWrite:
    # The input is a zone partitioned the same way, so its layout carries over without a shuffle.
    return write_zone(
        df,
        path,
        layout="inherit",
        on_empty=run.on_empty,
        partition_overwrite=run.partition_overwrite,
        metrics={"rows_in": F.count(F.lit(1))},
        check_inputs=False,
        report_partitions=report_partitions,
    )


def flatten_zone(spark: SparkSession, run: Run) -> Stage:
    target = run.zones["intermediate"]
    written = _counted_write(flatten(read_valid(spark, run.zones["validated"])), target, run)
    return Stage("intermediate", target, "success" if written.written else "skipped", **written.metrics)


def curate_zone(spark: SparkSession, run: Run) -> Stage:
    """Intermediate zone to curated zone, or straight from the validated zone where the former is not kept."""
    if run.keep_intermediate:
        source = read_intermediate(spark, run.zones["intermediate"])
    else:
        source = flatten(read_valid(spark, run.zones["validated"]))
    written = _counted_write(curate(source, run.run_date), run.curated, run, report_partitions=run.database is not None)
    status = "success" if written.written else "skipped"
    return Stage("curate", run.curated, status, partitions=written.partitions, **written.metrics)


def register_zone(spark: SparkSession, run: Run, partitions: Sequence[dict[str, str | None]] | None = None) -> Stage:
    """The curated zone as a table, its partitions told by the write that made them; without those they are looked for."""
    create_database(spark, run.database)
    if run.replacement == "versioned":
        register_version(spark, run.database, run.table, run.run_ts, CURATED, run.zones["curated"], partitions or [])
        switch_version(spark, run.database, run.table, run.run_ts)
        drop_versions(spark, run.database, run.table, run.zones["curated"], run.keep_versions)
    elif partitions is None or run.partition_overwrite == "dynamic" and not has_table(spark, run.database, run.table):
        register_table(spark, run.database, run.table, CURATED, run.curated, replace=True)
        repair_table(spark, run.database, run.table)
    else:
        # a static overwrite leaves no partition but its own; a dynamic one adds to those the table has
        register_table(spark, run.database, run.table, CURATED, run.curated, replace=run.partition_overwrite == "static")
        add_partitions(spark, run.database, run.table, partitions)
    return Stage("catalog", run.curated)


def report_zone(spark: SparkSession, run: Run) -> Stage:
    """Stores both reports below the run's results folder."""
    if run.database:
        curated = read_table(spark, run.database, run.table)
    else:
        curated = read_curated(spark, run.curated)
    results = f"{run.zones['results']}/run_ts={run.run_ts}"
    materialize(region_report(curated), f"{results}/region_report")
    materialize(top_k_report(curated, run.top_k), f"{results}/top_k_report")
    return Stage("report", results)


Work = tuple[str, Callable[[], Stage]]


def later_stages(spark: SparkSession, run: Run) -> list[Work]:
    """What follows the validated zone."""
    stages: list[Work] = []
    if run.keep_intermediate:
        stages.append(("intermediate", lambda: flatten_zone(spark, run)))
    made: list[dict[str, str | None]] = []

    def curate_and_note() -> Stage:
        done = curate_zone(spark, run)
        made[:] = done.partitions or []
        return done

    stages.append(("curate", curate_and_note))
    if run.database:
        stages.append(("catalog", lambda: register_zone(spark, run, made)))
    return [*stages, ("report", lambda: report_zone(spark, run))]


def run_stages(spark: SparkSession, run: Run, stages: Sequence[Work]) -> list[Stage]:
    """The stages in order, audited; a skipped one ends the run."""
    done = []
    for name, work in stages:
        done.append(audited(spark, run, name, work))
        if done[-1].status == "skipped":
            break
    return done


def run_medallion(
    spark: SparkSession, run: Run, records: DataFrame | None = None, fallback: DataFrame | None = None
) -> list[Stage]:
    """The whole chain. Without ``records`` it starts from what lies in the raw zone, or lands the fallback if nothing does."""
    stages: list[Work] = []
    if records is not None or not has_landed(spark, run.zones["raw"], run.run_ts):
        stages.append(("ingest", lambda: land_records(spark, run, records, fallback)))
    stages.append(("validate", lambda: validate_zone(spark, run)))
    return run_stages(spark, run, [*stages, *later_stages(spark, run)])


def run_local_variant(parsed: DataFrame, path: str, partition_by: str | None = "region") -> ZoneWrite:
    """The small variant: the weak rules, four columns, one replaced path."""
    valid, _ = validate(parsed, weak_rules())
    return write_zone(local_projection(valid), path, partition_by)
