import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cairn.contracts import CURATED
from cairn.functions.paths import is_record_file, rewrite_zone
from cairn.functions.values import run_stamp
from cairn.operators.archive import archive_files, archive_plan, finish_archives, move_files, open_run, open_runs, pending_moves
from cairn.operators.catalog import create_database, register_table, repair_table
from cairn.operators.reports import region_report, region_sum, region_sum_count, top_k_report
from cairn.operators.sinks import EmptyZone, land, materialize, overlapping, write_zone
from cairn.sources.files import has_landed, list_files, source_or_fallback
from cairn.sources.records import read_records
from cairn.sources.zones import read_curated, read_table, read_zone
from cairn.workspace import scratch_path, shared_root

DAY = dt.date(2024, 1, 31)


def curated(spark, rows):
    """``(name, region, population, area)`` as curated rows."""
    return spark.createDataFrame([(n, r, "sub", p, a, "", "", DAY) for n, r, p, a in rows], CURATED)


def regions(spark, path):
    return sorted((row.country_name, row.region) for row in read_curated(spark, path).collect())


def test_region_text_survives_the_round_trip(spark, tmp_path):
    names = ["01", "2", "a/b=c", "with space", "Ünï", "null", "%41", "2024-01-01"]
    rows = [(name, name, 1, 1.0) for name in names] + [("none", None, 1, 1.0)]
    path = write_zone(curated(spark, rows), str(tmp_path / "zone")).path
    back = read_curated(spark, path)
    assert back.schema == CURATED and back.columns == CURATED.fieldNames()
    assert {row.country_name: row.region for row in back.collect()} == {n: r for n, r, _, _ in rows}


def test_partition_filter_reaches_the_listing(spark, tmp_path):
    path = write_zone(curated(spark, [("a", "x", 1, 1.0), ("b", "y", 1, 1.0)]), str(tmp_path / "zone")).path
    plan = read_curated(spark, path).where(F.col("region") == "x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_static_and_dynamic_overwrite(spark, tmp_path):
    first, second = [("a", "x", 1, 1.0), ("b", "y", 1, 1.0)], [("c", "x", 1, 1.0)]
    for how, expected in (("static", [("c", "x")]), ("dynamic", [("b", "y"), ("c", "x")])):
        path = str(tmp_path / how)
        write_zone(curated(spark, first), path)
        write_zone(curated(spark, second), path, partition_overwrite=how)
        assert regions(spark, path) == expected


def test_unpartitioned_replacement(spark, tmp_path):
    path = str(tmp_path / "zone")
    for rows in ([("a", "x", 1, 1.0)], [("b", "y", 1, 1.0)]):
        write_zone(curated(spark, rows), path, None)
    assert regions(spark, path) == [("b", "y")]


def test_empty_input_by_choice(spark, tmp_path):
    path, full = str(tmp_path / "zone"), curated(spark, [("a", "x", 1, 1.0)])
    write_zone(full, path)
    empty = full.where("population > 5")
    with pytest.raises(EmptyZone):
        write_zone(empty, path, on_empty="fail")
    assert not write_zone(empty, path, on_empty="skip").written
    assert regions(spark, path) == [("a", "x")]
    write_zone(empty, path)
    assert read_curated(spark, path).count() == 0


def test_a_zone_is_not_overwritten_by_what_reads_it(spark, tmp_path):
    path = write_zone(curated(spark, [("a", "x", 1, 1.0)]), str(tmp_path / "zone")).path
    for target in (path, str(tmp_path), path + "/region=x"):
        with pytest.raises(ValueError, match="is read by"):
            write_zone(read_curated(spark, path), target)
    assert regions(spark, path) == [("a", "x")]
    assert overlapping("s3://b/a", "s3://b/a/c") and not overlapping("/a/b", "/a/bc")


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    """Half of all rows in one region: it is cut over several files, and the counts stay exact."""
    rows = spark.range(0, 400000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("country_name"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 7)).alias("region"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2mb")
    try:
        written = write_zone(rows, str(tmp_path / "zone"), metrics={"n": F.count(F.lit(1)), "hot": F.count_if(F.col("region") == "hot")})
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert written.metrics == {"n": 400000, "hot": 200000}
    files = [name for name in os.listdir(tmp_path / "zone" / "region=hot") if name.endswith(".parquet")]
    assert 4 <= len(files) <= 16
    assert read_zone(spark, written.path, rows.schema).distinct().count() == 400000


def test_inherited_layout_adds_no_shuffle(spark, tmp_path):
    path = write_zone(curated(spark, [(str(i), f"r{i % 3}", i, 1.0) for i in range(30)]), str(tmp_path / "one")).path
    copy = write_zone(read_curated(spark, path), str(tmp_path / "two"), layout="inherit", metrics={"n": F.count(F.lit(1))})
    assert copy.metrics == {"n": 30}
    for region in ("r0", "r1", "r2"):
        count = [sum(f.endswith(".parquet") for f in os.listdir(tmp_path / zone / f"region={region}")) for zone in ("one", "two")]
        assert count[0] == count[1] == 1


def test_catalog_table_shows_rows_after_repair(spark, tmp_path):
    path = write_zone(curated(spark, [("a", "x", 2, 1.0), ("b", "y", 3, 1.0)]), str(tmp_path / "zone")).path
    create_database(spark, "lake", str(tmp_path / "db"))
    create_database(spark, "lake", str(tmp_path / "db"))
    register_table(spark, "lake", "curated", CURATED, path, replace=True)
    assert read_table(spark, "lake", "curated").count() == 0
    repair_table(spark, "lake", "curated")
    table = read_table(spark, "lake", "curated")
    assert sorted(row.region for row in table.collect()) == ["x", "y"]
    assert "load_date" in table.columns
    write_zone(curated(spark, [("c", "z", 2, 1.0)]), path)
    repair_table(spark, "lake", "curated")
    spark.catalog.refreshTable("lake.curated")
    assert [row.region for row in read_table(spark, "lake", "curated").collect()] == ["z"]
    register_table(spark, "lake", "curated", CURATED, path)
    spark.sql("DROP TABLE lake.curated")
    assert read_curated(spark, path).count() == 1


def test_landing_is_per_run_and_never_overwrites(spark, tmp_path):
    zone, rows = str(tmp_path / "raw"), spark.createDataFrame([('{"a":1}',), ('{"a":2}',)], "record string")
    assert not has_landed(spark, zone)
    landed = land(rows, zone, "20240101_000000")
    assert landed.metrics == {"rows_in": 2, "n_bytes": 14}
    with pytest.raises(Exception, match="already exists"):
        land(rows, zone, "20240101_000000")
    empty = land(rows.limit(0), zone, "20240102_000000")
    assert empty.metrics == {"rows_in": 0, "n_bytes": 0}
    assert has_landed(spark, zone, "20240102_000000") and not has_landed(spark, empty.path)
    assert read_records(spark, empty.path).count() == 0
    assert read_records(spark, zone).count() == 2


def test_only_markers_means_nothing_landed(spark, tmp_path):
    (tmp_path / ".keep").write_text("")
    assert not has_landed(spark, str(tmp_path))
    assert read_records(spark, str(tmp_path)).count() == 0


def test_fallback_only_when_asked_and_absent(spark):
    rows = spark.range(2)
    assert {row.source_status for row in source_or_fallback(rows, rows.limit(0)).collect()} == {"success"}
    assert source_or_fallback(rows.limit(0), rows).count() == 0
    assert {row.source_status for row in source_or_fallback(None, rows).collect()} == {"fallback"}
    with pytest.raises(ValueError):
        source_or_fallback(None)


def test_paths(spark):
    zone = "raw/countries"
    cases = {
        "raw/countries/a.json": "archive/countries/a.json",
        "raw/countries/raw/countries/a.json": "archive/countries/raw/countries/a.json",
        "raw/countries_old/a.json": None,
        "x/raw/countries/a.json": None,
    }
    paths = spark.createDataFrame([(path,) for path in cases], "path string")
    rewritten = paths.select("path", rewrite_zone(F.col("path"), zone, "archive/countries/").alias("target"))
    assert {row.path: row.target for row in rewritten.collect()} == cases

    def one(path, zone, target):
        frame = spark.createDataFrame([(path,)], "path string")
        return frame.select(rewrite_zone(F.col("path"), zone, target)).first()[0]

    assert one("file:/raw/a.json", "/raw", "/old") == "file:/old/a.json"
    assert one("s3a://b/raw/a.json", "s3a://b/raw/", "s3a://b/old") == "s3a://b/old/a.json"
    assert one("hdfs://h:8020/raw/a.json", "/raw", "/old") == "hdfs://h:8020/old/a.json"
    kinds = spark.createDataFrame([("a.json",), ("a.keep",), ("a.json.keep",), ("a.csv",)], "path string")
    assert [row[0] for row in kinds.select(is_record_file(F.col("path"))).collect()] == [True, False, False, False]


def test_archiving_moves_data_files_only_and_can_be_repeated(spark, tmp_path):
    raw, archive = tmp_path / "raw", str(tmp_path / "archive")
    (raw / "run 1").mkdir(parents=True)
    names = ["a.json", "b%20c.json", "run 1/d e.json", "ü.json"]
    for name in names:
        (raw / name).write_text("{}")
    (raw / "notes.txt").write_text("")
    (raw / ".keep").write_text("")
    files, ledger = list_files(spark, str(raw)), str(tmp_path / "ledger")
    plan = spark.createDataFrame(archive_plan(files, str(raw), archive).collect())
    assert plan.count() == 4
    assert archive_files(files, str(raw), archive, ledger, "1") == 4
    assert sorted(os.listdir(raw)) == [".keep", "notes.txt", "run 1"]
    assert all(os.path.exists(os.path.join(archive, name)) for name in names)
    assert move_files(plan).count() == 4, "a task that runs again finds its files moved"
    assert finish_archives(spark, ledger) == 0


def test_a_run_that_died_while_archiving_is_finished_by_the_next(spark, tmp_path):
    raw, archive, ledger = tmp_path / "raw", str(tmp_path / "archive"), str(tmp_path / "ledger")
    raw.mkdir()
    for name in "abc":
        (raw / f"{name}.json").write_text("{}")
    plan = archive_plan(list_files(spark, str(raw)), str(raw), archive).withColumn("run_ts", F.lit("1"))
    write_zone(plan, f"{ledger}/planned", "run_ts", mode="append")
    os.makedirs(archive)
    os.rename(raw / "a.json", os.path.join(archive, "a.json"))
    (raw / "later.json").write_text("{}")
    assert finish_archives(spark, ledger) == 3
    assert os.listdir(raw) == ["later.json"] and sorted(os.listdir(archive)) == ["a.json", "b.json", "c.json"]
    assert archive_files(list_files(spark, str(raw)), str(raw), archive, ledger, "2") == 1
    assert os.listdir(raw) == []


def test_the_ledger_reads_open_runs_only(spark, tmp_path):
    raw, archive, ledger = tmp_path / "raw", str(tmp_path / "archive"), str(tmp_path / "ledger")
    for folder in ("x", "y/deep"):
        (raw / folder).mkdir(parents=True)
        for name in ("same.json", "other.JSON", "same.txt", ".keep"):
            (raw / folder / name).write_text(folder)
    assert archive_files(list_files(spark, str(raw)), str(raw), archive, ledger, "1") == 2
    assert [open(f"{archive}/{folder}/same.json").read() for folder in ("x", "y/deep")] == ["x", "y/deep"]
    assert archive_files(list_files(spark, str(raw)), str(raw), archive, ledger, "2", suffix="") == 4
    assert sorted(name for _, _, names in os.walk(raw) for name in names) == [".keep", ".keep"]
    # what closed runs left is never looked at again
    for run_ts in "12":
        for kind in ("planned", "done"):
            (tmp_path / "ledger" / kind / f"run_ts={run_ts}" / "part-0.parquet").write_text("no table")
    assert open_runs(spark, ledger) == [] and finish_archives(spark, ledger) == 0
    # a run that died before it planned, and one that died with a move made, are closed by the next
    open_run(spark, ledger, "3")
    open_run(spark, ledger, "4")
    (raw / "a.json").write_text("a")
    (raw / "b.json").write_text("b")
    plan = archive_plan(list_files(spark, str(raw)), str(raw), archive)
    write_zone(plan, f"{ledger}/planned/run_ts=4", None)
    os.rename(raw / "a.json", f"{archive}/a.json")
    assert open_runs(spark, ledger) == ["3", "4"] and pending_moves(spark, ledger, "4").count() == 2
    assert finish_archives(spark, ledger) == 2 and open_runs(spark, ledger) == []
    assert pending_moves(spark, ledger, "4").count() == 0 and open(f"{archive}/b.json").read() == "b"


def test_region_report_with_null_group(spark):
    rows = [("a", "x", 10, 1.0), ("b", "x", 5, 1.0), ("c", None, 7, 1.0), ("d", "y", 22, 1.0), ("e", "x", 5, 1.0)]
    report = region_report(curated(spark, rows)).collect()
    assert [tuple(row) for row in report] == [("y", 22, 1, 22.0, 22, 22), ("x", 20, 3, 6.67, 10, 5), (None, 7, 1, 7.0, 7, 7)]
    assert report[0].asDict().keys() == {
        "region", "total_population", "country_count", "avg_population", "max_population", "min_population"
    }
    assert {tuple(row) for row in region_sum(curated(spark, rows)).collect()} == {("x", 20), ("y", 22), (None, 7)}
    assert [tuple(row) for row in region_sum_count(curated(spark, rows)).collect()] == [("y", 22, 1), ("x", 20, 3), (None, 7, 1)]


def test_sum_overflow_is_an_error(spark):
    rows = [("a", "x", 2**62, 1.0), ("b", "x", 2**62, 1.0)]
    with pytest.raises(Exception, match="overflow"):
        region_report(curated(spark, rows)).collect()


def test_top_k_is_deterministic_at_ties(spark):
    rows = [(f"n{i:02}", "x", 100 if i >= 10 else 200, 0.0 if i == 3 else 8.0) for i in range(60)]
    expected = [f"n{i:02}" for i in range(50)]
    for parts in (1, 7):
        top = top_k_report(curated(spark, rows[::-1]).repartition(parts))
        assert [row.country_name for row in top.collect()] == expected
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    density = {row.country_name: row.population_density for row in top.collect()}
    assert density["n03"] is None and density["n04"] == 25.0


def test_materialize(spark, tmp_path):
    report = region_report(curated(spark, [("a", "x,\"y\"", 10, 1.0), ("b", None, 5, 1.0)]))
    path = materialize(report, str(tmp_path / "csv"))
    back = spark.read.schema(report.schema).option("header", True).option("escape", "\\").csv(path)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, report.collect()), key=str)


def test_run_stamp_and_scratch(spark):
    moment = spark.sql("SELECT timestamp'2024-02-03 04:05:06' t").select(run_stamp(F.col("t"))).first()[0]
    assert moment == "20240203_040506"
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_root(spark))
