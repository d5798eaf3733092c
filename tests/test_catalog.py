import json
import time

import pytest
from pyspark.sql import functions as F

from cairn.contracts import CURATED
from cairn.operators import catalog
from cairn.operators.sinks import write_zone
from cairn.plans import medallion
from cairn.plans.medallion import Run, run_medallion
from cairn.sources.files import folder_names
from cairn.sources.zones import read_table
from cairn.workspace import scratch_path


@pytest.fixture
def database(spark):
    catalog.create_database(spark, "catalog_tests", scratch_path(spark, "database"))
    return "catalog_tests"


def rows(spark, *regions):
    return spark.createDataFrame([(i, region) for i, region in enumerate(regions)], "k int, region string")


def seen(spark, database, table):
    return sorted((row.k, row.region) for row in read_table(spark, database, table).select("k", F.coalesce("region", F.lit("-")).alias("region")).collect())


def test_a_write_reports_its_partitions(spark):
    path = scratch_path(spark, "zone")
    written = write_zone(rows(spark, "a", None, "b=c/d", "a", "", "it's"), path, report_partitions=True)
    assert sorted(written.partitions, key=repr) == sorted([{"region": r} for r in ("a", None, "b=c/d", "it's")], key=repr)
    assert write_zone(rows(spark, "a"), path, report_partitions=True, metrics={"n": F.count(F.lit(1))}).metrics == {"n": 1}
    assert write_zone(rows(spark, "a"), path).partitions is None
    assert write_zone(rows(spark).limit(0), path, report_partitions=True).partitions == []


def test_reported_partitions_are_all_the_catalog_learns(spark, database):
    path = scratch_path(spark, "zone")
    made = write_zone(rows(spark, "a", None, "b=c/d", "it's"), path, report_partitions=True).partitions
    catalog.register_table(spark, database, "reported", rows(spark, "a").schema, path, replace=True)
    catalog.add_partitions(spark, database, "reported", made)
    assert seen(spark, database, "reported") == [(0, "a"), (1, "-"), (2, "b=c/d"), (3, "it's")]
    write_zone(rows(spark, "ghost"), path, partition_overwrite="dynamic")
    catalog.add_partitions(spark, database, "reported", made)
    catalog.drop_partitions(spark, database, "reported", [{"region": "a"}, {"region": None}, {"region": "never was"}])
    assert seen(spark, database, "reported") == [(2, "b=c/d"), (3, "it's")]


def test_differences():
    a, b, c = {"region": "a"}, {"region": "b"}, {"region": None}
    assert catalog.partition_difference([a, c], [b, c]) == ([b], [a])
    assert catalog.partition_difference([], [a]) == ([a], []) and catalog.partition_difference([a], [a]) == ([], [])


def test_one_new_partition_costs_the_same_beside_thousands(spark, database):
    def seconds(many):
        path = scratch_path(spark, "zone")
        catalog.register_table(spark, database, "many", rows(spark, "a").schema, path, replace=True)
        catalog.add_partitions(spark, database, "many", [{"region": f"r{i}"} for i in range(many)])
        new = write_zone(rows(spark, "new"), path, report_partitions=True, partition_overwrite="dynamic").partitions
        start = time.perf_counter()
        catalog.add_partitions(spark, database, "many", new)
        took = time.perf_counter() - start
        assert read_table(spark, database, "many").where("region = 'new'").count() == 1
        return took

    few, thousands = min(seconds(1) for _ in range(2)), seconds(2000)
    # a repair looks for 2,000 folders; this looks for none
    assert thousands < few + 0.5


def test_a_table_shows_one_version_or_the_other(spark, database):
    zone, schema = scratch_path(spark, "zone"), rows(spark, "a").schema

    def prepare(version, *regions):
        made = write_zone(rows(spark, *regions), catalog.version_path(zone, version), report_partitions=True).partitions
        catalog.register_version(spark, database, "shown", version, schema, zone, made)

    assert catalog.current_version(spark, database, "shown") is None
    prepare("v1", "a", "b")
    assert catalog.switch_version(spark, database, "shown", "v1") is None
    prepare("v2", "c")
    # a run that is killed here has changed nothing
    assert seen(spark, database, "shown") == [(0, "a"), (1, "b")] and catalog.current_version(spark, database, "shown") == "v1"
    reader = read_table(spark, database, "shown")
    assert catalog.switch_version(spark, database, "shown", "v2") == "v1"
    assert seen(spark, database, "shown") == [(0, "c")] and reader.count() == 2
    prepare("v3", "d")
    assert catalog.drop_versions(spark, database, "shown", zone, keep=1) == [] and reader.count() == 2
    catalog.switch_version(spark, database, "shown", "v3")
    assert catalog.drop_versions(spark, database, "shown", zone, keep=1) == ["v1"]
    assert sorted(folder_names(spark, zone)) == ["version=v2", "version=v3"] and catalog.versions(spark, database, "shown") == ["v2", "v3"]
    assert [row.region for row in read_table(spark, database, "shown").where("region = 'd'").collect()] == ["d"]
    with pytest.raises(ValueError):
        catalog.switch_version(spark, database, "shown", "v3; DROP")


def country(i):
    return json.dumps({"name": {"common": f"n{i}"}, "region": f"r{i % 3}", "population": 10 + i})


def test_a_versioned_run_that_dies_before_the_switch_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "lake")

    def run(run_ts, *numbers):
        run = Run(root, run_ts, replacement="versioned", database="versioned_runs")
        run_medallion(spark, run, spark.createDataFrame([(country(i),) for i in numbers], "record string"))
        return run

    first = run("20240101_000000", 1, 2, 3)
    names = lambda: sorted(row.country_name for row in read_table(spark, first.database, first.table).collect())
    assert names() == ["n1", "n2", "n3"]

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(medallion, "switch_version", die)
        run("20240102_000000", 4)
    assert names() == ["n1", "n2", "n3"]
    run("20240103_000000", 5, 6)
    assert names() == ["n5", "n6"]
    assert sorted(read_table(spark, first.database, first.table).columns) == sorted(CURATED.fieldNames())


def test_versions_need_a_database(spark):
    with pytest.raises(ValueError, match="replacement"):
        Run("x", replacement="versioned")
    with pytest.raises(ValueError, match="replacement"):
        Run("x", replacement="other")


def test_a_dynamic_run_keeps_the_other_partitions_in_the_catalog(spark):
    root = scratch_path(spark, "lake")
    for run_ts, numbers in (("1", (0, 1, 2)), ("2", (3,)), ("3", (7,))):
        run = Run(root, run_ts, partition_overwrite="dynamic", database="dynamic_runs")
        run_medallion(spark, run, spark.createDataFrame([(country(i),) for i in numbers], "record string"))
    found = sorted(row.country_name for row in read_table(spark, "dynamic_runs", run.table).collect())
    assert found == ["n2", "n3", "n7"]
