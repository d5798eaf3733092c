"""Data-quality rules as data, and the split into valid and rejected records."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.contracts import CHECKED, CORRUPT, REJECTED, REQUIRED_FIELDS, VALID
from cairn.functions.values import exceeds, falls_below

UNREADABLE = "readable"
MAX_FOLDER = 240


@dataclass(frozen=True)
class Rule:
    """A named condition. A row it gives NULL for breaks it."""

    name: str
    holds: Column


@dataclass(frozen=True)
class FieldRule:
    """A rule as data: what must hold for the field at a dotted path (a part that holds a dot stands in backquotes).

    ``kind`` is one of ``KINDS``; ``bound`` is its number, pattern or JSON list of texts. With ``allow_nulls``
    a NULL field keeps the rule.
    """

    name: str
    field: str
    kind: str
    bound: str | None = None
    allow_nulls: bool = False


def _bounds(rule: FieldRule) -> float:
    try:
        return float(rule.bound)
    except (TypeError, ValueError):
        raise ValueError(f"rule {rule.name}: {rule.kind} needs a number, not {rule.bound!r}") from None


def _listed(rule: FieldRule) -> list[str]:
    try:
        listed = json.loads(rule.bound)
    except (TypeError, ValueError):
        listed = None
    if not isinstance(listed, list):
        raise ValueError(f"rule {rule.name}: {rule.kind} needs a JSON list, not {rule.bound!r}")
    return [str(item) for item in listed]


def _patterned(rule: FieldRule) -> str:
    if rule.bound is None:
        raise ValueError(f"rule {rule.name}: {rule.kind} needs a pattern")
    return rule.bound


#: What a field must be: there; a number strictly above or strictly below the bound; text with a match of the
#: pattern; one of the listed texts. Numbers that a BIGINT cannot hold keep neither bound.
KINDS: dict[str, Callable[[Column, FieldRule], Column]] = {
    "required": lambda value, rule: value.isNotNull(),
    "minimum": lambda value, rule: exceeds(value, _bounds(rule)),
    "maximum": lambda value, rule: falls_below(value, _bounds(rule)),
    "pattern": lambda value, rule: value.cast("string").rlike(_patterned(rule)),
    "member": lambda value, rule: value.cast("string").isin(_listed(rule)),
}
RULES = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        *(T.StructField(name, T.StringType()) for name in ("name", "field", "kind", "bound")),
        T.StructField("allow_nulls", T.BooleanType()),
    ]
)
MAX_RULES = 1000


def contract_rules(
    required: Iterable[str] = REQUIRED_FIELDS,
    population_min: float | None = 0,
    allow_nulls: bool = False,
) -> list[FieldRule]:
    """The rules a configuration states: fields that must not be NULL, and an exclusive minimum."""
    rules = [] if allow_nulls else [FieldRule(f"{name}_required", _quoted(name), "required") for name in required]
    if population_min is not None:
        rules.append(FieldRule("population_min", "population", "minimum", repr(float(population_min))))
    return rules


def rules_from_table(rows: DataFrame) -> list[FieldRule]:
    """The rules of a table with the columns of ``RULES``, in the order of their position, then their name.

    Rules are configuration: more than ``MAX_RULES`` are refused, so the driver gets a bounded number of rows. A
    rule without a name is called by its field and kind; NULL for ``allow_nulls`` means false.
    """
    found = rows.select(*RULES.fieldNames()).orderBy("position", "name", "field", "kind").limit(MAX_RULES + 1).collect()
    if len(found) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rules = []
    for row in found:
        if row["field"] is None or row["kind"] not in KINDS:
            raise ValueError(f"a rule needs a field and one of the kinds {sorted(KINDS)}: {row}")
        rules.append(FieldRule(row["name"] or f"{row['field']}_{row['kind']}", row["field"], row["kind"], row["bound"], bool(row["allow_nulls"])))
    return rules


def _quoted(name: str) -> str:
    return f"`{name}`" if "." in name else name


def path_parts(path: str) -> list[str]:
    """The names of a dotted path; backquotes keep a name with dots together."""
    parts = re.findall(r"`([^`]+)`|([^.`]+)", path)
    if not parts or ".".join(f"`{quoted}`" if quoted else plain for quoted, plain in parts) != path:
        raise ValueError(f"not a path: {path!r}")
    return [quoted or plain for quoted, plain in parts]


def field_at(df: DataFrame, path: str, record: str = "record") -> Column:
    """The field at a path of a frame: its own column, nested or the member of a map, else a member of the record's JSON."""
    parts = path_parts(path)
    found, kind = None, df.schema
    for part in parts:
        if isinstance(kind, T.StructType) and part in kind.fieldNames():
            kind = kind[part].dataType
            found = F.col(f"`{part}`") if found is None else found.getField(part)
        elif isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
            found, kind = F.try_element_at(found, F.lit(part)), kind.valueType
        else:
            break
    else:
        return found
    if record in df.columns and isinstance(df.schema[record].dataType, T.StringType):
        if any(mark in part for part in parts for mark in "'[]?"):
            raise ValueError(f"no path into a record: {path!r}")
        return F.get_json_object(F.col(record), "$" + "".join(f"['{part}']" for part in parts))
    raise ValueError(f"no field {path!r} among {df.columns}, and no {record!r} to look it up in")


def bind_rules(df: DataFrame, rules: Sequence[Rule | FieldRule]) -> list[Rule]:
    """The rules as conditions over the frame's columns."""
    bound = []
    for rule in rules:
        if isinstance(rule, FieldRule):
            value = field_at(df, rule.field)
            holds = KINDS[rule.kind](value, rule)
            rule = Rule(rule.name, value.isNull() | holds if rule.allow_nulls else holds)
        bound.append(rule)
    return bound


def folder_rule() -> Rule:
    """Valid rows are stored in a folder for each region, whose escaped name must fit a file system."""
    escaped = F.regexp_replace("region", r'[\x00-\x1f"#%\'*/:=?\\\x7f{\[\]^]', "%00")
    return Rule("region_folder", F.coalesce(F.octet_length(escaped) <= MAX_FOLDER, F.lit(True)))


def weak_rules() -> list[FieldRule]:
    """The local run's rules: population alone."""
    return contract_rules(required=("population",))


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row breaks, in the order given; empty for a valid row."""
    broken = [F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.name)) for rule in rules]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def all_hold(rules: Sequence[Rule]) -> Column:
    """TRUE for a valid row; FALSE or NULL otherwise. Plain conditions, so a filter on it reaches the scan."""
    return functools.reduce(Column.__and__, [rule.holds for rule in rules], F.lit(True))


def validate(df: DataFrame, rules: Sequence[Rule | FieldRule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and the others with ``reasons``. To write both in one pass use ``check``."""
    rules = bind_rules(df, rules)
    valid = all_hold(rules)
    rejected = df.where(~F.coalesce(valid, F.lit(False)))
    return df.where(valid), rejected.withColumn("reasons", broken_rules(rules))


def check(parsed: DataFrame, rules: Sequence[Rule | FieldRule]) -> DataFrame:
    """Every parsed record with its verdict, in the validated zone's columns.

    A record that does not parse has that as its only reason. Every row keeps the record's text, which
    holds the fields that the contract does not name. The verdict comes from the conditions, not from the list of
    reasons, which is made for rejected rows alone, and not at all where only verdicts are wanted.
    """
    rules = bind_rules(parsed, rules)
    unreadable = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(UNREADABLE)))
    rejected = F.col(CORRUPT).isNotNull() | ~F.coalesce(all_hold(rules), F.lit(False))
    return parsed.select(
        *[name for name in CHECKED.fieldNames() if name not in ("reasons", "verdict")],
        F.when(rejected, F.coalesce(unreadable, broken_rules(rules))).alias("reasons"),
        F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(VALID)).alias("verdict"),
    ).select(*CHECKED.fieldNames())


def rule_counts(rules: Sequence[Rule | FieldRule], reasons: str = "reasons") -> dict[str, Column]:
    """An aggregate for each rule, counting the rows of checked records that broke it; records that do not parse too."""
    return {name: F.count_if(F.coalesce(F.array_contains(reasons, name), F.lit(False))) for name in (UNREADABLE, *(rule.name for rule in rules))}


def quality_metrics(df: DataFrame, rules: Sequence[Rule | FieldRule]) -> DataFrame:
    """Rows in, valid and rejected, and rows breaking each rule: one ``metric``, ``n_rows`` line each, one scan."""
    rules = bind_rules(df, rules)
    valid = F.coalesce(all_hold(rules), F.lit(False))
    counts = {"rows_in": F.lit(True), "rows_valid": valid, "rows_rejected": ~valid}
    counts |= {f"broken:{rule.name}": ~F.coalesce(rule.holds, F.lit(False)) for rule in rules}
    totals = df.agg(*[F.count_if(condition).alias(f"n{i}") for i, condition in enumerate(counts.values())])
    lines = [F.struct(F.lit(name).alias("metric"), F.col(f"n{i}").alias("n_rows")) for i, name in enumerate(counts)]
    return totals.select(F.inline(F.array(*lines)))
