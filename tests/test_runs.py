import datetime as dt
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cairn.contracts import CHECKED
from cairn.operators.rules import contract_rules, quality_metrics, validate, weak_rules
from cairn.operators.sinks import EmptyZone, land, read_audit
from cairn.operators.transforms import flatten
from cairn.operators.archive import FILES_PER_TASK
from cairn.plans.medallion import Run, land_records, run_local_variant, run_medallion, validate_zone
from cairn.sources.files import list_files
from cairn.sources.records import parse_records, read_records
from cairn.sources.zones import read_curated, read_rejected, read_table, read_valid, read_zone
from cairn.streaming.incremental import run_incremental
from cairn.workspace import scratch_path

DAY = dt.date(2024, 1, 31)


def country(i, **changes):
    base = {"name": {"common": f"n{i}"}, "region": f"r{i % 3}", "population": 10 + i, "area": 2, "capital": ["c"]}
    return json.dumps({**base, **changes})


def records(spark, texts):
    return spark.createDataFrame([(text,) for text in texts], "record string")


def new_run(spark, run_ts="20240131_000000", root=None, **choices):
    return Run(root or scratch_path(spark, "lake"), run_ts, DAY, **choices)


def names(frame):
    return sorted(row.country_name for row in frame.collect())


def audit(spark, run):
    return {row.stage: row for row in read_audit(spark, run.audit).where(F.col("run_ts") == run.run_ts).collect()}


def test_whole_run(spark):
    texts = [country(i) for i in range(20)] + [country(20, population=0), "broken", country(21, region="")]
    run = new_run(spark, database="lake_runs")
    stages = run_medallion(spark, run, records(spark, texts))
    assert [stage.stage for stage in stages] == ["ingest", "validate", "intermediate", "curate", "catalog", "report"]
    assert names(read_curated(spark, run.zones["curated"])) == sorted(f"n{i}" for i in [*range(20), 21])
    assert read_table(spark, "lake_runs", run.table).where("region IS NULL").count() == 1
    rejected = {row.record: row.reasons for row in read_rejected(spark, run.zones["validated"]).collect()}
    assert rejected == {country(20, population=0): ["population_min"], "broken": ["readable"]}
    rows = audit(spark, run)
    # one text is no object and lands in quotes
    assert (rows["ingest"].rows_in, rows["ingest"].n_bytes) == (23, sum(map(len, texts)) + 2)
    assert (rows["validate"].rows_in, rows["validate"].rows_valid, rows["validate"].rows_rejected) == (23, 21, 2)
    assert rows["validate"].files_archived == read_records(spark, run.zones["archive"]).select("file_path").distinct().count()
    assert rows["curate"].rows_in == 21 and {row.status for row in rows.values()} == {"success"}
    assert list_files(spark, run.zones["raw"]).count() == 0
    report = f"{run.zones['results']}/run_ts={run.run_ts}"
    assert sorted(os.listdir(report)) == ["region_report", "top_k_report"]


def test_running_twice_on_the_same_landed_data(spark):
    texts = [country(i) for i in range(10)]
    root, seen = scratch_path(spark, "lake"), []
    for run_ts in ("20240101_000000", "20240102_000000"):
        run = new_run(spark, run_ts, root, archive_raw=False)
        run_medallion(spark, run, records(spark, texts) if not seen else None)
        seen.append(sorted(map(tuple, read_curated(spark, run.zones["curated"]).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 10


def test_a_later_run_replaces_or_keeps_regions(spark):
    for how, expected in (("static", ["n3"]), ("dynamic", ["n1", "n2", "n3"])):
        root = scratch_path(spark, "lake")
        run_medallion(spark, new_run(spark, "1", root, partition_overwrite=how), records(spark, [country(i) for i in (0, 1, 2)]))
        run = new_run(spark, "2", root, partition_overwrite=how)
        run_medallion(spark, run, records(spark, [country(3)]))
        assert names(read_curated(spark, run.zones["curated"])) == expected


def test_required_field_absent_everywhere(spark):
    run = new_run(spark)
    texts = ['{"name": {"common": "a"}, "region": "x"}', '{"name": {"common": "b"}}']
    with pytest.raises(ValueError, match=r"missing required columns: \['population'\]"):
        run_medallion(spark, run, records(spark, texts))
    rows = audit(spark, run)
    assert set(rows) == {"ingest", "validate"}
    assert rows["validate"].status == "failure" and "population" in rows["validate"].error


@pytest.mark.parametrize("choice", ["fail", "skip", "write"])
def test_an_empty_run_and_the_curated_zone(spark, choice):
    root = scratch_path(spark, "lake")
    run_medallion(spark, new_run(spark, "1", root), records(spark, [country(1)]))
    run = new_run(spark, "2", root, on_empty=choice)
    bad = records(spark, [country(2, population=0)])
    if choice == "fail":
        with pytest.raises(EmptyZone):
            run_medallion(spark, run, bad)
    else:
        run_medallion(spark, run, bad)
    left = names(read_curated(spark, run.zones["curated"]))
    assert left == ([] if choice == "write" else ["n1"])


def test_nothing_landed_and_the_fallback(spark):
    with pytest.raises(ValueError, match="no fallback"):
        run_medallion(spark, new_run(spark))
    run = new_run(spark)
    run_medallion(spark, run, fallback=records(spark, [country(1)]))
    assert audit(spark, run)["ingest"].source_status == "fallback"
    assert names(read_curated(spark, run.zones["curated"])) == ["n1"]


def test_an_empty_landed_answer_is_not_replaced_by_the_fallback(spark):
    run = new_run(spark, on_empty="skip")
    land(records(spark, [country(1)]).limit(0), run.zones["raw"], run.run_ts)
    stages = run_medallion(spark, run, fallback=records(spark, [country(1)]))
    assert [(stage.stage, stage.status) for stage in stages] == [("validate", "skipped")]


def test_indented_array_files_as_raw_zone(spark, tmp_path):
    raw = tmp_path / "raw" / "records"
    raw.mkdir(parents=True)
    for name in "ab":
        rows = [json.loads(country(i, name={"common": f"{name}{i}"})) for i in range(5)]
        (raw / f"countries_raw_{name}.json").write_text(json.dumps(rows, indent=2))
    run = new_run(spark, root=str(tmp_path), raw_layout="indented", raw_suffix=".json", keep_intermediate=False)
    run_medallion(spark, run)
    assert names(read_curated(spark, run.zones["curated"])) == sorted(f"{name}{i}" for name in "ab" for i in range(5))
    assert sorted(os.listdir(tmp_path / "archive" / "records")) == ["countries_raw_a.json", "countries_raw_b.json"]
    assert os.listdir(raw) == []


def test_choices_are_checked(spark):
    with pytest.raises(ValueError, match="on_empty"):
        new_run(spark, on_empty="maybe")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.one_of(
            st.text(max_size=12).filter(lambda text: text.strip(" \t\r\n") and "\n" not in text and "\r" not in text),
            st.fixed_dictionaries(
                {},
                optional={
                    "name": st.one_of(st.none(), st.just("x"), st.fixed_dictionaries({"common": st.text(max_size=3)})),
                    "region": st.one_of(st.none(), st.sampled_from(["", "a", "b/c", "01"])),
                    "population": st.one_of(st.none(), st.integers(-5, 5), st.floats(-2, 2), st.text(max_size=3)),
                    "capital": st.lists(st.one_of(st.none(), st.text(max_size=2)), max_size=2),
                    "currencies": st.dictionaries(st.text(max_size=2), st.none(), max_size=2),
                },
            ).map(json.dumps),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_valid_and_rejected_make_up_what_landed(spark, texts):
    run = new_run(spark, on_empty="write", archive_raw=False)
    landed = land(records(spark, texts), run.zones["raw"], run.run_ts)
    try:
        stage = validate_zone(spark, run)
    except ValueError as missing:
        assert "missing required columns" in str(missing)
        return
    path = run.zones["validated"]
    counts = read_valid(spark, path).count(), read_rejected(spark, path).count()
    assert sum(counts) == landed.metrics["rows_in"] == stage.rows_in == len(texts)
    assert counts == (stage.rows_valid, stage.rows_rejected)
    flat = flatten(read_valid(spark, path))
    assert flat.where("population IS NULL").count() == 0


def test_rules_and_metrics(spark):
    frame = parse_records(records(spark, [country(1), country(2, region=None), country(3, population=None, name=None)]).withColumn("file_path", F.lit(None)))
    valid, rejected = validate(frame, contract_rules())
    assert valid.count() == 1
    assert sorted(map(tuple, [row.reasons for row in rejected.collect()])) == [
        ("name_required", "population_required", "population_min"),
        ("region_required",),
    ]
    assert validate(frame, weak_rules())[0].count() == 2
    assert validate(frame, contract_rules(population_min=None, allow_nulls=True))[0].count() == 3
    assert validate(frame, contract_rules(population_min=10))[0].count() == 1
    assert validate(frame, contract_rules(population_min=11))[0].count() == 0
    metrics = {row.metric: row.n_rows for row in quality_metrics(frame, contract_rules()).collect()}
    assert metrics["rows_in"] == 3 and metrics["rows_rejected"] == 2 and metrics["broken:population_min"] == 1


def test_local_variant(spark):
    frame = parse_records(records(spark, [country(1, region=None), country(2, population=0)]).withColumn("file_path", F.lit(None)))
    for partition_by in ("region", None):
        written = run_local_variant(frame, scratch_path(spark, "local"), partition_by)
        back = spark.read.schema("country_name string, region string, population bigint, currency_name string").parquet(written.path)
        assert [row.country_name for row in back.collect()] == ["n1"]


def drop(folder, name, texts):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(texts) + "\n")


def test_incremental_run_equals_the_batch_run_and_archives_later(spark, tmp_path):
    raw, validated, archive = tmp_path / "raw", str(tmp_path / "validated"), tmp_path / "archive"

    def trigger():
        run_incremental(spark, str(raw), validated, str(tmp_path / "checkpoint"), str(archive)).awaitTermination()
        return names(flatten(read_valid(spark, validated)))

    first = [country(i) for i in range(6)] + ["broken"]
    drop(raw, "1.json", first)
    assert trigger() == [f"n{i}" for i in range(6)]
    run = new_run(spark, archive_raw=False)
    land(records(spark, first), run.zones["raw"], run.run_ts)
    validate_zone(spark, run)
    columns = ["record", "reasons"]
    assert names(flatten(read_valid(spark, run.zones["validated"]))) == names(flatten(read_valid(spark, validated)))
    assert read_rejected(spark, validated).select(columns).collect() == read_rejected(spark, run.zones["validated"]).select(columns).collect()

    assert trigger() == [f"n{i}" for i in range(6)], "a run without new files leaves the zone as it is"
    assert (raw / "1.json").exists()
    drop(raw, "2.json", [country(7)])
    assert trigger() == ["n7"]
    archived = [name for _, _, files in os.walk(archive) for name in files]
    assert "1.json" in archived and not (raw / "1.json").exists() and (raw / "2.json").exists()


def test_incremental_append_keeps_batches_apart(spark, tmp_path):
    raw, validated = tmp_path / "raw", str(tmp_path / "validated")
    for i in range(3):
        drop(raw, f"{i}.json", [country(i)])
    run_incremental(spark, str(raw), validated, str(tmp_path / "cp"), keep="append", max_files=1).awaitTermination()
    assert sorted(name for name in os.listdir(validated) if name.startswith("batch")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert names(flatten(read_valid(spark, validated))) == ["n0", "n1", "n2"]
    together = str(tmp_path / "together")
    run_incremental(spark, str(raw), together, str(tmp_path / "cp2"), max_files=1)
    assert names(flatten(read_valid(spark, together))) == ["n0", "n1", "n2"]


def test_an_incremental_run_without_valid_rows_keeps_the_zone_and_the_rejected_rows(spark, tmp_path):
    raw, validated, checkpoint = tmp_path / "raw", str(tmp_path / "validated"), str(tmp_path / "cp")
    drop(raw, "1.json", [country(1)])
    run_incremental(spark, str(raw), validated, checkpoint, on_empty="fail")
    drop(raw, "2.json", [country(2, population=0)])
    with pytest.raises(EmptyZone):
        run_incremental(spark, str(raw), validated, checkpoint, on_empty="fail")
    assert names(flatten(read_valid(spark, validated))) == ["n1"]
    drop(raw, "3.json", [country(3)])
    run_incremental(spark, str(raw), validated, checkpoint, on_empty="fail")
    assert names(flatten(read_valid(spark, validated))) == ["n3"]
    assert [row.record for row in read_rejected(spark, validated).collect()] == [country(2, population=0)]
    drop(raw, "4.json", ['{"region": "x", "population": 1}'])
    with pytest.raises(ValueError, match="name"):
        run_incremental(spark, str(raw), validated, checkpoint)


def test_valid_rows_keep_the_fields_outside_the_contract(spark, tmp_path):
    run = new_run(spark, root=str(tmp_path))
    land(records(spark, [country(1, extra={"a": [1, 2]})]), run.zones["raw"], run.run_ts)
    validate_zone(spark, run)
    kept = read_zone(spark, run.zones["validated"], CHECKED).where("verdict = 'valid'")
    assert kept.select(F.get_json_object("record", "$.extra")).first()[0] == '{"a":[1,2]}'


def test_landing_keeps_every_record_and_archives_what_it_read(spark, tmp_path):
    good = '{"name":{"common":"a"},"region":"%s","population":1}'
    texts = [None, "", good % "x", '[1,\n2', good % "x" + "{}", good % ("r" * 300)]
    run = Run(root=str(tmp_path), run_ts="1")
    records = spark.createDataFrame([(text,) for text in texts], "record string")
    assert land_records(spark, run, records).rows_in == 6
    nested = tmp_path / "raw" / run.dataset / "more" / "deep"
    nested.mkdir(parents=True)
    (nested / "b.json").write_text(good % "y" + "\n")
    done = validate_zone(spark, run)
    assert (done.rows_in, done.rows_valid, done.rows_rejected) == (7, 2, 5)
    left = [path for path in (tmp_path / "raw").rglob("*") if path.is_file() and path.stat().st_size and not path.name.startswith((".", "_"))]
    assert left == [] and done.files_archived >= 2


def test_required_fields_are_demanded_when_nulls_are_allowed(spark, tmp_path):
    run = Run(root=str(tmp_path), run_ts="1", allow_nulls=True)
    land_records(spark, run, spark.createDataFrame([('{"region":"x","population":1}',)], "record string"))
    with pytest.raises(ValueError, match="name"):
        validate_zone(spark, run)


def test_moves_are_planned_as_many_tasks(spark):
    paths = spark.range(20_000).select(F.concat(F.lit("/raw/"), F.col("id")).alias("path"))
    assert paths.repartition(-(-20_000 // FILES_PER_TASK), "path").rdd.getNumPartitions() == 200
