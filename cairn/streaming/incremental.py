"""New raw files only: each run validates what came since the last one, and archives what it is done with."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cairn.contracts import CHECKED, REQUIRED_FIELDS
from cairn.operators.rules import FieldRule, Rule, check, contract_rules
from cairn.operators.sinks import write_zone
from cairn.plans.medallion import Run, Stage, audited, counted_stage, gate, later_stages, run_rules, run_stages, verdict_counts, write_checked
from cairn.sources.files import has_landed, remove_folder
from cairn.sources.records import parse_records, read_records
from cairn.sources.zones import read_zone


def run_incremental(
    spark: SparkSession,
    raw: str,
    validated: str,
    checkpoint: str,
    archive: str | None = None,
    keep: str = "replace",
    layout: str = "lines",
    rules: Sequence[Rule | FieldRule] | None = None,
    max_files: int | None = None,
    on_empty: str = "write",
    required: Sequence[str] = REQUIRED_FIELDS,
    on_batch: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """One run over the files that no earlier run with this checkpoint has seen, to its end; the ended query comes back.

    Every batch first writes its own place whole, so one that is repeated after a failure does not double its rows.

    keep  ``append`` adds the batches to the zone, under a ``batch_id`` partition. ``replace`` keeps them
          beside the checkpoint until all are there, and then replaces the zone with them at once. Batches of
          a run that failed before that are still there and go into the zone with the next run's.
    archive  Where the file source moves a file during a later run, once its batch is committed.
    max_files  Splits a backlog into batches.
    on_empty  What replacing does when no new row is valid: ``write`` empties the valid zone, ``fail`` raises and
              ``skip`` returns. Both leave the zone as it was, and the rejected rows wait for the next run.
    required  Fields that some new record must carry, else the run fails; appended batches stay.
    on_batch  Gets the number and the counts of each batch.
    """
    if keep not in ("replace", "append"):
        raise ValueError(f"keep: {keep}")
    options = {"cleanSource": "archive", "sourceArchiveDir": archive} if archive else {}
    if max_files:
        options["maxFilesPerTrigger"] = str(max_files)
    rules = contract_rules() if rules is None else rules
    checked = check(parse_records(read_records(spark, raw, layout, options)), rules)
    home = validated if keep == "append" else f"{checkpoint.rstrip('/')}/pending"
    written = []

    def store(batch: DataFrame, batch_id: int) -> None:
        counts = write_zone(
            batch.withColumn("batch_id", F.lit(batch_id)),
            home,
            ("batch_id", "verdict", "region"),
            partition_overwrite="dynamic",
            metrics=verdict_counts(rules),
            check_inputs=False,
        ).metrics
        written.append(batch_id)
        if on_batch:
            on_batch(batch_id, counts)

    query = (
        checked.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if keep == "append" and written:
        gate(_batches(spark, home).where(F.col("batch_id").isin(written)), required, rules, "write", validated, stored=True)
    elif keep == "replace" and has_landed(spark, home):
        new = _batches(spark, home)
        if gate(new, required, rules, on_empty, validated, stored=True):
            # the batches lie in folders of their own verdict and region already
            write_checked(new.drop("batch_id"), validated, layout="inherit")
            # if the run dies before this, the next one puts these batches into the zone again
            remove_folder(spark, home)
    return query


def _batches(spark: SparkSession, path: str) -> DataFrame:
    return read_zone(spark, path, T.StructType([*CHECKED.fields, T.StructField("batch_id", T.LongType())]))


def validate_new_files(
    spark: SparkSession, run: Run, checkpoint: str, keep: str = "replace", max_files: int | None = None
) -> Stage:
    """New raw files to the validated zone; one audit row for each batch, besides the stage's own."""
    target, totals = run.zones["validated"], {"rows_in": 0, "rows_valid": 0, "rows_rejected": 0}

    def counted(batch_id: int, counts: dict[str, int]) -> None:
        audited(spark, run, "batch", lambda: counted_stage("batch", f"batch_id={batch_id}", counts))
        for name, count in counts.items():
            totals[name] = totals.get(name, 0) + count

    archive = run.zones["archive"] if run.archive_raw else None
    run_incremental(
        spark, run.zones["raw"], target, checkpoint, archive, keep, run.raw_layout, run_rules(run), max_files, run.on_empty, run.required, counted
    )
    # A run in which nothing became visible leaves the zones behind it alone.
    stale = totals["rows_in"] == 0 or (run.on_empty == "skip" and totals["rows_valid"] == 0)
    return counted_stage("validate", target, totals, status="skipped" if stale else "success")


def run_medallion_incremental(
    spark: SparkSession, run: Run, checkpoint: str, keep: str = "replace", max_files: int | None = None
) -> list[Stage]:
    """The whole chain over the files that came since the last run with this checkpoint."""
    validate = ("validate", lambda: validate_new_files(spark, run, checkpoint, keep, max_files))
    return run_stages(spark, run, [validate, *later_stages(spark, run)])
