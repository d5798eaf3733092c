import json

import pytest
from pyspark.sql import functions as F

from cairn.contracts import CHECKED
from cairn.functions.values import canonical_json, without_nulls
from cairn.operators.rules import MAX_RULES, RULES, FieldRule, check, contract_rules, field_at, path_parts, rules_from_table, validate
from cairn.operators.sinks import write_zone
from cairn.operators.transforms import flatten
from cairn.sources.records import parse_records
from cairn.sources.zones import read_valid, read_zone
from cairn.workspace import scratch_path


def rules(spark, *rows):
    return rules_from_table(spark.createDataFrame(rows, RULES))


def records(spark, *objects):
    texts = [(text if isinstance(text, str) else json.dumps(text), None) for text in objects]
    return parse_records(spark.createDataFrame(texts, "record string, file_path string"))


@pytest.mark.parametrize("path, parts", [("a", ["a"]), ("a.b.c", ["a", "b", "c"]), ("a.`b.c`.d", ["a", "b.c", "d"]), ("`x y`", ["x y"])])
def test_paths(path, parts):
    assert path_parts(path) == parts


@pytest.mark.parametrize("path", ["", ".", "a.", "a..b", "`a", "a`b`"])
def test_what_is_no_path(path):
    with pytest.raises(ValueError):
        path_parts(path)


def test_rules_come_in_the_order_of_their_position(spark):
    found = rules(spark, (2, None, "b", "required", None, None), (1, "first", "a", "minimum", "3", True))
    assert found == [FieldRule("first", "a", "minimum", "3", True), FieldRule("b_required", "b", "required")]


@pytest.mark.parametrize(
    "row", [(1, "x", None, "required", None, False), (1, "x", "a", "sum", None, False), (1, "x", "a", None, None, False)]
)
def test_a_rule_needs_a_field_and_a_kind(spark, row):
    with pytest.raises(ValueError, match="one of the kinds"):
        rules(spark, row)


@pytest.mark.parametrize("kind, bound", [("minimum", "three"), ("minimum", None), ("maximum", ""), ("member", "[1"), ("member", '"x"'), ("pattern", None)])
def test_a_bound_that_does_not_fit_its_kind(spark, kind, bound):
    with pytest.raises(ValueError, match="rule r"):
        validate(spark.createDataFrame([(1,)], "a int"), rules(spark, (1, "r", "a", kind, bound, False)))


def test_more_rules_than_a_configuration_has(spark):
    with pytest.raises(ValueError, match=str(MAX_RULES)):
        rules_from_table(spark.range(MAX_RULES + 1).selectExpr("CAST(id AS INT) position", "'n' name", "'a' field", "'required' kind", "NULL bound", "false allow_nulls"))


def test_a_field_is_looked_up_in_the_frame_first_then_in_the_record(spark):
    frame = records(spark, {"name": {"common": "c", "native": "n"}, "region": "r", "population": 1, "extra": {"deep.er": {"x": 5}}, "currencies": {"K": {"name": "k"}}})
    row = frame.select(
        field_at(frame, "name.common").alias("column"), field_at(frame, "name.native").alias("member"),
        field_at(frame, "extra.`deep.er`.x").alias("deep"), field_at(frame, "nothing.at.all").alias("absent"),
    ).first()
    assert tuple(row) == ("c", "n", "5", None)
    assert frame.where(field_at(frame, "currencies.K").isNotNull()).count() == 1 and frame.where(field_at(frame, "currencies.L").isNotNull()).count() == 0


def test_a_field_that_is_nowhere_is_named(spark):
    with pytest.raises(ValueError, match="'c.d'"):
        validate(spark.createDataFrame([(1,)], "a int"), [FieldRule("r", "c.d", "required")])
    with pytest.raises(ValueError, match="no path into a record"):
        field_at(records(spark, {}), "it`s".replace("`", "'"))


def test_kinds_and_nulls(spark):
    frame = spark.createDataFrame([(1, "5", "ab"), (2, "x", "cd"), (3, None, None), (4, "12", "ab")], "k int, n string, t string")
    cases = {
        ("required", None, False): [1, 2, 4], ("minimum", "4", False): [1, 4], ("minimum", "5", False): [4], ("maximum", "12", False): [1],
        ("minimum", "4", True): [1, 3, 4], ("pattern", "^[0-9]+$", False): [1, 4], ("member", '["x", 5]', False): [1, 2], ("required", None, True): [1, 2, 3, 4],
    }
    for (kind, bound, nulls), expected in cases.items():
        valid, rejected = validate(frame, [FieldRule("r", "n", kind, bound, nulls)])
        assert sorted(row.k for row in valid.collect()) == expected, (kind, bound, nulls)
        assert sorted(row.k for row in rejected.where("reasons = array('r')").collect()) == sorted({1, 2, 3, 4} - set(expected))


def test_contract_rules_on_a_frame_without_records(spark):
    frame = spark.createDataFrame([("a", 5.0), (None, 9.0)], "c_name string, population double")
    assert validate(frame, contract_rules(required=("c_name",), population_min=2))[0].count() == 1


CURRENCIES = [
    ({"Z": {"name": "z", "symbol": None, "rate": 1.5}, "A": {"sub": {"b": [1, None, {"y": None, "x": "t"}], "a": None}}}, '{"A":{"sub":{"b":[1,null,{"x":"t"}]}},"Z":{"name":"z","rate":1.5}}'),
    ({"A": None, "B": {"c": None}}, '{"B":{}}'),
    ({"A": {"name": 'q"\\":null,'}}, '{"A":{"name":"q\\"\\\\\\":null,"}}'),
    ({'k"y': {"n\\": None, "m": "\n\t\u0001"}}, '{"k\\"y":{"m":"\\n\\t\\u0001"}}'),
    ({"A": "plain", "B": 5, "C": [None], "D": False}, '{"A":"plain","B":5,"C":[null],"D":false}'),
    ({"é": {"日": "本"}}, '{"é":{"日":"本"}}'),
]


@pytest.mark.parametrize("given, text", CURRENCIES)
def test_currencies_keep_all_their_members(spark, given, text):
    record = {"name": {"common": "c"}, "region": "r", "population": 1, "currencies": given}
    checked = check(records(spark, record), contract_rules())
    assert flatten(checked.where("verdict = 'valid'")).first().currency == text
    path = write_zone(checked, scratch_path(spark, "zone"), ("verdict", "region")).path
    assert flatten(read_valid(spark, path)).first().currency == text
    assert read_zone(spark, path, CHECKED).select(canonical_json(F.col("currencies"))).first()[0] == text


def test_very_long_texts_and_many_escapes_in_currencies(spark):
    long = '\\"' * 60_000 + "x" * 200_000
    text = json.dumps({"A": {"name": long, "gone": None}}, separators=(",", ":"))
    kept = spark.createDataFrame([(text,)], "t string").select(without_nulls(F.col("t"))).first()[0]
    assert json.loads(kept) == {"A": {"name": long}}
