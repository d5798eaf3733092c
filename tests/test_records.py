import json

import pytest
from pyspark.sql import functions as F

from cairn.contracts import CORRUPT, REQUIRED_FIELDS
from cairn.operators.rules import check, contract_rules
from cairn.operators.sinks import EmptyZone
from cairn.operators.transforms import curate, enrich, flatten
from cairn.plans.medallion import gate
from cairn.sources.observed import (
    field_presence,
    flatten_dotted,
    missing_fields,
    observed_fields,
    observed_schema,
    require_columns,
)
from cairn.sources.records import arrays_to_records, parse_records, read_records, read_texts, scan_arrays


def records(spark, *texts):
    return spark.createDataFrame([(text, None) for text in texts], "record string, file_path string")


def checked(spark, *texts):
    return check(parse_records(records(spark, *texts)), contract_rules())


def valid(spark, *rows):
    return checked(spark, *[row if isinstance(row, str) else json.dumps(row) for row in rows]).where("verdict = 'valid'")


def country(**changes):
    base = {
        "name": {"common": "Aland", "official": "Republic of Aland"},
        "region": "North",
        "subregion": "Far North",
        "population": 1200,
        "area": 50.0,
        "capital": ["Alpha", "Beta"],
        "currencies": {"ZZD": {"name": "Zed", "symbol": "z"}, "AAD": {"name": "Ayd"}},
    }
    merged = {**base, **changes}
    return {key: value for key, value in merged.items() if value is not ...}


def test_all_fields_and_document_order(spark):
    row = flatten(valid(spark, country())).first()
    assert row.currency == '{"AAD":{"name":"Ayd"},"ZZD":{"name":"Zed","symbol":"z"}}'
    wide = enrich(valid(spark, country())).first()
    assert (wide.currency_code, wide.currency_name, wide.population_density) == ("ZZD", "Zed", 24.0)
    assert (wide.official_name, wide.capital) == ("Republic of Aland", "Alpha")


@pytest.mark.parametrize(
    "absent, expected",
    [
        (["subregion"], {"subregion": None}),
        (["subregion", "currencies"], {"subregion": None, "currency": ""}),
        (["area", "capital"], {"area": None, "capital_city": ""}),
    ],
)
def test_fields_no_record_carries(spark, absent, expected):
    row = flatten(valid(spark, country(**{name: ... for name in absent}))).first().asDict()
    assert {name: row[name] for name in expected} == expected


def test_official_name_may_be_absent(spark):
    assert enrich(valid(spark, country(name={"common": "B"}))).first().official_name is None


@pytest.mark.parametrize(
    "population, reasons",
    [
        (0, ["population_min"]),
        (-1, ["population_min"]),
        (None, ["population_required", "population_min"]),
        (..., ["population_required", "population_min"]),
        ("n/a", ["population_min"]),
        ("NaN", ["population_min"]),
        ("1.x", ["population_min"]),
        ("Infinity", ["population_min"]),
        ("9223372036854775808", ["population_min"]),
        (1e300, ["population_min"]),
    ],
)
def test_bad_populations(spark, population, reasons):
    row = checked(spark, json.dumps(country(population=population))).first()
    assert (row.verdict, row.reasons) == ("rejected", reasons)
    assert json.loads(row.record) == json.loads(json.dumps(country(population=population)))


@pytest.mark.parametrize(
    "population, stored",
    [
        ("12", 12),
        (3.7, 3),
        (0.5, 0),
        (".5", 0),
        (" 7 ", 7),
        ("1.5e3", 1500),
        (2.5e9, 2500000000),
        (9007199254740993, 9007199254740993),
        ("9007199254740993.5", 9007199254740993),
        ("9223372036854775807", 2**63 - 1),
    ],
)
def test_good_populations(spark, population, stored):
    assert flatten(valid(spark, country(population=population))).first().population == stored


def test_blank_region_is_null_after_flattening(spark):
    assert checked(spark, json.dumps(country(region=None))).first().reasons == ["region_required"]
    assert flatten(valid(spark, country(region=""))).first().region is None


def test_names(spark):
    assert checked(spark, json.dumps(country(name=None))).first().reasons == ["name_required"]
    assert flatten(valid(spark, country(name={}))).first().country_name is None
    assert checked(spark, json.dumps(country(name="plain"))).first().reasons == ["readable"]


def test_capitals(spark):
    cities = [flatten(valid(spark, country(capital=capital))).first().capital_city for capital in ([], [None], None)]
    assert cities == ["", None, ""]


def test_currencies(spark):
    for given, text in (({}, "{}"), ({"ZZZ": None}, "{}"), (None, ""), ({"A": {"name": 'q"\\'}}, '{"A":{"name":"q\\"\\\\"}}')):
        assert flatten(valid(spark, country(currencies=given))).first().currency == text


def test_repeated_currency_codes_keep_first_place_and_last_value(spark):
    repeated = '{"name":{"common":"n"},"region":"r","population":1,"currencies":{"K":{"name":"old"},"A":{"name":"a"},"K":{"name":"new"}}}'
    assert flatten(valid(spark, repeated)).first().currency == '{"A":{"name":"a"},"K":{"name":"new"}}'
    assert enrich(valid(spark, repeated)).first().currency_name == "new"


def test_first_currency_name_skips_empty_ones(spark):
    names = {"A": {"name": ""}, "B": {"symbol": "b"}, "C": None, "D": {"name": "dee"}}
    assert enrich(valid(spark, country(currencies=names))).first().currency_name == "dee"


@pytest.mark.parametrize("area", [0, "x", None])
def test_density_needs_an_area(spark, area):
    assert enrich(valid(spark, country(area=area))).first().population_density is None


@pytest.mark.parametrize("text", ['{"name": {"common"', "5", '"text"', "null", "", "[" + json.dumps(country()) + "]", "nonsense"])
def test_what_is_no_object_is_quarantined_alone(spark, text):
    rows = checked(spark, json.dumps(country()), text).collect()
    assert sorted(row.verdict for row in rows) == ["rejected", "valid"]
    bad = next(row for row in rows if row.verdict == "rejected")
    assert (bad.record, bad.reasons, bad.region) == (text, ["readable"], None)


def test_lines_isolate_bad_records_and_array_files_do_not(spark, tmp_path):
    good = json.dumps(country())
    (tmp_path / "lines.json").write_text(f"{good}\n\n{good[:-5]}\n  \n{good}\n")
    read = check(parse_records(read_records(spark, str(tmp_path))), contract_rules())
    assert {row["verdict"]: row["count"] for row in read.groupBy("verdict").count().collect()} == {"valid": 2, "rejected": 1}

    folder = tmp_path / "arrays"
    folder.mkdir()
    broken = f"[{good},{good[:-5]},{good}]"
    (folder / "bad.json").write_text(broken)
    (folder / "good.json").write_text(f"[{good},null]")
    (folder / "empty.json").write_text("[]")
    read = parse_records(read_records(spark, str(folder), "whole"))
    rows = [(row.record, row[CORRUPT]) for row in read.collect()]
    assert len(rows) == 3
    assert (broken, broken) in rows and (None, "null") in rows


def test_two_files_are_read_together_without_removing_duplicates(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}.json").write_text(json.dumps([country()], indent=2))
    for layout in ("indented", "whole"):
        read = read_records(spark, str(tmp_path), layout)
        assert (read.count(), read.select("file_path").distinct().count()) == (2, 2)
    assert scan_arrays(spark, str(tmp_path)).count() == 2


def test_indented_arrays_are_read_by_many_tasks(spark, tmp_path):
    rows = [country(name={"common": f"n{i}"}, capital=["a]", "\n  {\n", "},", "["] if i % 2 else []) for i in range(3000)]
    rows[0] = rows[17] = {}
    (tmp_path / "big.json").write_text(json.dumps(rows, indent=2))
    (tmp_path / "compact.json").write_text(json.dumps(rows[:20]))
    (tmp_path / "wide.json").write_text(json.dumps(rows[:20], indent=4))
    (tmp_path / "none.json").write_text("[]\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64kb")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        texts = read_texts(spark, str(tmp_path), "indented")
        assert texts.rdd.getNumPartitions() > 8
        read = read_records(spark, str(tmp_path), "indented")
        names = read.groupBy(F.get_json_object("record", "$.name.common").alias("name")).count()
        counts = {row["name"]: row["count"] for row in names.collect()}
        parsed = parse_records(read)
        assert parsed.where(F.col(CORRUPT).isNotNull()).count() == 0
        capitals = {tuple(row.capital) for row in parsed.where("capital IS NOT NULL").select("capital").distinct().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = {f"n{i}": 3 if i < 20 else 1 for i in range(3000) if i not in (0, 17)}
    assert counts == {**expected, None: 6}
    assert capitals == {(), ("a]", "\n  {\n", "},", "[")}


@pytest.mark.parametrize("cut", range(1, 60, 7))
def test_a_cut_indented_array_never_yields_a_made_up_record(spark, tmp_path, cut):
    rows = [country(name={"common": f"n{i}"}, population=1000 + i) for i in range(3)]
    (tmp_path / "cut.json").write_text(json.dumps(rows, indent=2)[:-cut])
    read = check(parse_records(read_records(spark, str(tmp_path), "indented")), contract_rules())
    kept = flatten(read.where("verdict = 'valid'")).select("country_name", "population", "currency").collect()
    whole = {(f"n{i}", 1000 + i) for i in range(3)}
    assert {(row.country_name, row.population) for row in kept} <= whole
    assert all("Zed" in row.currency and "Ayd" in row.currency for row in kept)
    assert len(kept) >= 2


def test_observed_fields_and_gate(spark):
    seen = records(spark, '{"a": 1, "b": null}', '{"a": 2}', "broken", '{"c": {"d": 1}}')
    assert {row.field: row.n_records for row in observed_fields(seen).collect()} == {"a": 2, "b": 1, "c": 1}
    assert missing_fields(seen, ["a", "b", "name", "d"]) == ["name", "d"]
    presence = {row.field: (row.n_records, row.present) for row in field_presence(seen, ["a", "name"]).collect()}
    assert presence == {"a": (2, True), "name": (0, False)}
    assert observed_schema(seen).first().schema == "OBJECT<a: BIGINT, b: VOID, c: OBJECT<d: BIGINT>>"


def test_the_gate_reads_all_records_at_most_once(spark):
    """Without a valid row: the first rows, then all, in one pass that counts, and not some partitions after others."""
    body = json.dumps(country()).replace('"population"', '"people"')
    seen = check(parse_records(records(spark, *[body] * 64, "broken").repartition(65)), contract_rules())
    counts = {}
    spark.sparkContext.setJobGroup("gate", "gate")
    try:
        with pytest.raises(ValueError, match=r"missing required columns: \['population'\]"):
            gate(seen, REQUIRED_FIELDS, contract_rules(), "skip", "the zone", counts)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("gate")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == {"rows_in": 65, "rows_valid": 0}
    # a shuffle of its own and a result for each: the 65 partitions, the first rows, all of them
    assert len(jobs) <= 6


def test_the_gate_finds_a_valid_row_behind_many_rejected(spark):
    seen = check(parse_records(records(spark, *["{}"] * 300, json.dumps(country())).coalesce(1)), contract_rules())
    counts = {}
    assert gate(seen, REQUIRED_FIELDS, contract_rules(), "fail", "the zone", counts) and counts == {"rows_in": 301, "rows_valid": 1}
    with pytest.raises(EmptyZone):
        gate(seen.where("verdict = 'none'"), REQUIRED_FIELDS, contract_rules(), "fail", "the zone")


def test_required_columns(spark):
    frame = spark.range(1).withColumn("name", F.lit("x"))
    assert require_columns(frame, ["name"]) is frame
    with pytest.raises(ValueError, match="population.*region"):
        require_columns(frame, ["name", "population", "region"])


def test_flatten_dotted(spark):
    frame = spark.sql("SELECT named_struct('a', 1, 'b', named_struct('c', 2)) s, array(1) l, map('k', 1) m, 3 AS `x.y`")
    assert flatten_dotted(frame).columns == ["s.a", "s.b.c", "l", "m", "x.y"]
    assert flatten_dotted(frame).first()["s.b.c"] == 2


def test_curated_columns(spark):
    import datetime as dt

    row = curate(flatten(valid(spark, country())), dt.date(2024, 2, 29)).first()
    assert row.asDict().keys() >= {"country_name", "region", "currency", "load_date"}
    assert row.load_date == dt.date(2024, 2, 29)
    assert curate(flatten(valid(spark, country()))).first().load_date is not None


@pytest.mark.parametrize("blanks", [1, 80, 300])
def test_a_lone_bracket_is_no_record_however_it_is_spaced(spark, blanks):
    pieces = ["[" + " " * blanks, '"region": "a"\n  },', '"region": "b"\n  }\n]']
    texts = spark.createDataFrame([(piece, None) for piece in pieces], "value string, file_path string")
    assert arrays_to_records(texts, "indented").count() == 2


@pytest.mark.parametrize("text", ['[{"a":1}][{"b":2}]', '[{"a":1}] x', '[{"a":1}'])
def test_text_behind_an_array_rejects_the_whole_text(spark, text):
    texts = spark.createDataFrame([(text, None)], "value string, file_path string")
    assert [row.record for row in arrays_to_records(texts, "whole").collect()] == [text]


@pytest.mark.parametrize("text", ["{}{}", "{} x", "{},{}", "{}]", "{}\n{}"])
def test_text_behind_an_object_rejects_it(spark, text):
    row = checked(spark, text).first()
    assert (row.verdict, row.reasons, row.record) == ("rejected", ["readable"], text)
