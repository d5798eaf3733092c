"""Expressions over the fields of one record."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

BIGINT_END = 2.0**63


def blank_to_null(text: Column) -> Column:
    """``''`` as NULL. A blank partition value reads back as NULL, so it is made one before the write."""
    return F.nullif(text, F.lit(""))


def number(value: Column) -> Column:
    """DOUBLE, or NULL where the text is no number."""
    return value.try_cast("double")


def whole_number(value: Column) -> Column:
    """BIGINT: fractions truncated, NULL for anything a BIGINT cannot hold.

    Without an exponent the digits before the point are cast, which is exact and, unlike casting
    text that has a fraction to BIGINT, does not fail inside for every such value.
    """
    text = value.cast("string")
    # A cast from DOUBLE takes 2^63 for the largest BIGINT.
    rounded = F.when(number(value) < F.lit(BIGINT_END), number(value).try_cast("bigint"))
    digits = F.substring_index(text, ".", 1).try_cast("bigint")
    has_exponent = F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))
    whole = F.when(has_exponent, rounded).otherwise(F.coalesce(digits, rounded))
    return F.when(number(value).isNotNull(), whole)


def exceeds(value: Column, minimum: float) -> Column:
    """Strictly above ``minimum``, tested before truncation, so 0.5 exceeds 0.

    NaN, infinities and magnitudes beyond BIGINT fail: Spark orders NaN above every number.
    """
    return (number(value) > F.lit(minimum)) & whole_number(value).isNotNull()


def falls_below(value: Column, maximum: float) -> Column:
    """Strictly below ``maximum``, for the numbers ``exceeds`` knows."""
    return (number(value) < F.lit(maximum)) & whole_number(value).isNotNull()


def first_or_blank(items: Column) -> Column:
    """First element; ``''`` for a NULL or empty array. A NULL first element stays NULL."""
    return F.when(F.size(items) > 0, F.get(items, F.lit(0))).otherwise(F.lit(""))


def _last_value(entries: Column, key: Column) -> Column:
    return F.element_at(F.filter(entries, lambda entry: entry["key"] == key), -1)["value"]


def unique_keys(members: Column) -> Column:
    """A map whose repeated keys are merged: the first place, the last value, as JSON objects are read.

    Parsed JSON may repeat a member, and Spark's map builders refuse such maps.
    """
    keys, entries = F.map_keys(members), F.map_entries(members)
    merged = F.transform(
        F.array_distinct(keys),
        lambda key: F.struct(key.alias("key"), _last_value(entries, key).alias("value")),
    )
    repeated = (F.size(members) > 1) & (F.size(F.array_distinct(keys)) < F.size(members))
    return F.when(repeated, F.map_from_entries(merged)).otherwise(members)


def canonical_json(members: Column) -> Column:
    """JSON text of a map of VARIANT, keys in order and null members dropped at every level; ``''`` for a NULL map.

    The text does not depend on the order the members were written in. A null inside an array stays.
    """
    keys = F.array_sort(F.map_keys(members))
    ordered = F.map_from_entries(F.transform(keys, lambda key: F.struct(key, F.element_at(members, key))))
    return F.when(members.isNotNull(), without_nulls(F.to_json(ordered))).otherwise(F.lit(""))


def without_nulls(text: Column) -> Column:
    """Compact JSON text without its null members.

    Escapes inside strings are set aside as control characters, which JSON text cannot hold, so that a
    string is all up to the next quote; a string before ``:null`` can only be a member's key.
    """
    marked = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    kept = F.regexp_replace(marked, '("[^"]*+")(?!:null[,}])|"[^"]*+":null,?', "$1")
    closed = F.regexp_replace(kept, '("[^"]*+")|,(?=\\})', "$1")
    return F.replace(F.replace(closed, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))


def first_currency_name(currencies: Column) -> Column:
    """The first non-empty name in document order, else NULL."""
    names = F.transform(F.map_values(currencies), lambda member: F.try_variant_get(member, "$.name", "string"))
    return F.try_element_at(F.filter(names, lambda name: name != ""), F.lit(1))


def first_key(members: Column) -> Column:
    """The first key in document order, else NULL."""
    return F.try_element_at(F.map_keys(members), F.lit(1))


def density(population: Column, area: Column) -> Column:
    """People per unit of area to two digits; NULL where the area is 0 or unknown."""
    return F.round(population / F.nullif(area, F.lit(0.0)), 2)


def load_date(run_date: dt.date | None = None) -> Column:
    """The given date, or the day the query runs."""
    return F.current_date() if run_date is None else F.lit(run_date).cast("date")


def run_stamp(moment: Column | None = None) -> Column:
    """``yyyyMMdd_HHmmss`` of a moment, by default of the query's start."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyyMMdd_HHmmss")
