"""Moving processed raw files out of the raw zone, as a Spark job over the file listing.

The moves are planned in a written table first. A listing looks at its files again whenever it is
computed, which fails once some are gone; a table does not, so a lost task or a run that died half
way can move the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.contracts import MOVES
from cairn.functions.paths import is_record_file, rewrite_zone
from cairn.operators.sinks import write_zone
from cairn.sources.files import folder_names, has_landed, remove_folder
from cairn.sources.zones import read_zone


FILES_PER_TASK = 100


def archive_plan(files: DataFrame, zone: str, archive_zone: str, suffix: str = ".json") -> DataFrame:
    """``path`` and ``archive_path`` of the data files of a listing; markers stay where they are."""
    target = rewrite_zone(F.col("path"), zone, archive_zone)
    plan = files.where(is_record_file(F.col("path"), suffix)).select("path", target.alias("archive_path"))
    return plan.where(F.col("archive_path").isNotNull())


def move_files(plan: DataFrame) -> DataFrame:
    """Moves each ``path`` to its ``archive_path``, giving both back; the moves happen when the result is read.

    A task that runs twice finds its file moved and reports it the same way.
    """

    # Nested, so that it travels to the executors by value and needs no package there.
    def move_batches(batches):
        import posixpath
        from urllib.parse import quote

        from pyarrow import fs

        def resolve(path):
            scheme, colon, rest = path.partition(":")
            if not colon or scheme == "file":
                return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
            scheme = "s3" if scheme in ("s3a", "s3n") else scheme
            return fs.FileSystem.from_uri(quote(f"{scheme}:{rest}", safe="/:"))

        def move(source, target):
            filesystem, source = resolve(source)
            _, target = resolve(target)
            filesystem.create_dir(posixpath.dirname(target), recursive=True)
            try:
                filesystem.move(source, target)
            except FileNotFoundError:
                if filesystem.get_file_info(target).type == fs.FileType.NotFound:
                    raise

        for batch in batches:
            for source, target in zip(batch["path"], batch["archive_path"]):
                move(source, target)
            yield batch

    return plan.mapInPandas(move_batches, plan.schema)


def archive_files(files: DataFrame, zone: str, archive_zone: str, ledger: str, run_ts: str, suffix: str = ".json") -> int:
    """Archives the data files of a listing and returns their number.

    ``ledger`` keeps what was planned and done, a folder for each run. ``open`` names the runs that are not finished; the
    others' folders are never listed again, so a run's work does not grow with the history.
    """
    spark = files.sparkSession
    open_run(spark, ledger, run_ts)
    plan = archive_plan(files, zone, archive_zone, suffix)
    write_zone(plan, run_folder(ledger, "planned", run_ts), None, layout="inherit", mode="append")
    return finish_archives(spark, ledger)


def run_folder(ledger: str, kind: str, run_ts: str) -> str:
    return f"{ledger}/{kind}/run_ts={run_ts}"


def open_run(spark: SparkSession, ledger: str, run_ts: str) -> None:
    """Names a run as unfinished, before it plans anything."""
    _mark(spark, run_folder(ledger, "open", run_ts))


def _mark(spark: SparkSession, path: str) -> None:
    spark.range(1).write.mode("overwrite").parquet(path)


def open_runs(spark: SparkSession, ledger: str) -> list[str]:
    """Runs that are not finished. A ledger that never named any is of before there were names: all that planned count."""
    names = folder_names(spark, f"{ledger}/open") or folder_names(spark, f"{ledger}/planned")
    return sorted(name.removeprefix("run_ts=") for name in names if name.startswith("run_ts="))


def pending_moves(spark: SparkSession, ledger: str, run_ts: str) -> DataFrame:
    """The moves a run planned and has not made. Reads that run's folders, and no other's."""
    planned = read_zone(spark, run_folder(ledger, "planned", run_ts), MOVES)
    if not has_landed(spark, run_folder(ledger, "done", run_ts)):
        return planned
    return planned.join(read_zone(spark, run_folder(ledger, "done", run_ts), MOVES), "path", "left_anti").select(*MOVES.fieldNames())


def finish_archives(spark: SparkSession, ledger: str) -> int:
    """Makes the moves that were planned and not yet made by open runs, this one or an earlier one, and closes them; returns
    their number. A run that died before its plan was written planned nothing."""
    made, made_before = 0, "since" in folder_names(spark, f"{ledger}/open")
    for run_ts in open_runs(spark, ledger):
        if has_landed(spark, run_folder(ledger, "planned", run_ts)):
            pending = pending_moves(spark, ledger, run_ts)
            # A number of its own, or the adaptive planner would join all moves in one task.
            moved = move_files(pending.repartition(max(1, -(-pending.count() // FILES_PER_TASK)), "path"))
            counted = {"n": F.count(F.lit(1))}
            made += write_zone(moved, run_folder(ledger, "done", run_ts), None, layout="inherit", mode="append", metrics=counted).metrics["n"]
        # from now on the folder holds something, whichever runs are open
        if not made_before:
            _mark(spark, f"{ledger}/open/since")
            made_before = True
        remove_folder(spark, run_folder(ledger, "open", run_ts))
    return made
