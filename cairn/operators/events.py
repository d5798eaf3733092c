"""Status-event messages: fields out of JSON text that producers spell differently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.values import unique_keys

# Fixed values of the message format: alternative keys in their order, and what stands in for an absent member.
JOB_NAME_KEYS = ("jobName", "JobName", "job_name")
REASON_KEYS = ("reason", "error", "failureReason")
DEFAULT_STATUS = "UNKNOWN"
DEFAULT_STAGE = "pipeline"
DEFAULT_SOURCE = "stepfunctions"

# Texts of the values that count as not given: empty text, zero, false, empty containers.
# All but the first are given when they are quoted.
NOT_GIVEN = ("", "0", "0.0", "-0.0", "false", "{}", "[]")


def _parsed(text: Column) -> Column:
    """JSON text as VARIANT, NULL if it is none; of repeated members the last counts.

    A generator, so that the text is parsed once per row whatever is asked of the result. Objects
    that repeat a member are no VARIANT as they stand, so what looks like one is tried again merged.
    """
    merged = F.to_json(unique_keys(F.from_json(text, "MAP<STRING, VARIANT>")))
    retried = F.when(text.rlike(r"^\s*\{"), F.try_parse_json(merged))
    return F.explode(F.array(F.coalesce(F.try_parse_json(text), retried)))


def _member(parsed: str, key: str, as_type: str = "string") -> Column:
    """A member of a parsed object; as VARIANT it is SQL NULL when absent and a variant null when it is null."""
    return F.try_variant_get(F.col(parsed), f'$["{key}"]', as_type)


def _given_text(parsed: str, key: str) -> Column:
    text = _member(parsed, key)
    quoted = (text != "") & (F.schema_of_variant(_member(parsed, key, "variant")) == "STRING")
    return F.when(~text.isin(*NOT_GIVEN) | quoted, text)


def _first_given(parsed: str, keys: Sequence[str]) -> Column:
    return F.coalesce(*[_given_text(parsed, key) for key in keys])


def _text_or_default(parsed: str, key: str, default: Column) -> Column:
    """The default stands in for an absent member only: an explicit null stays NULL."""
    return F.when(_member(parsed, key, "variant").isNull(), default).otherwise(_member(parsed, key))


def event_field(df: DataFrame, body: str, alias: str, default: str, keys: Sequence[str] = JOB_NAME_KEYS) -> DataFrame:
    """Adds ``alias``: the first of ``keys`` that is given, else the default, also for text that is no JSON object."""
    parsed = df.select("*", _parsed(F.col(body)).alias("_body"))
    return parsed.withColumn(alias, F.coalesce(_first_given("_body", keys), F.lit(default))).drop("_body")


def normalise_events(df: DataFrame, body: str) -> DataFrame:
    """Replaces a status message by its fields, taken out of a ``Payload`` envelope where there is one.

    Text that is no JSON object gives the defaults.
    """
    carried = [name for name in df.columns if name != body]
    parsed = df.select(*carried, _parsed(F.col(body)).alias("_body"))
    opened = parsed.withColumn("_body", F.coalesce(_member("_body", "Payload", "variant"), F.col("_body")))
    named = opened.withColumns(
        {
            "status": _text_or_default("_body", "status", F.lit(DEFAULT_STATUS)),
            "stage": _text_or_default("_body", "stage", F.lit(DEFAULT_STAGE)),
        }
    )
    # A null is spelled None in the default message, as its readers know it.
    stage, status = (F.coalesce(F.col(name), F.lit("None")) for name in ("stage", "status"))
    message = F.concat(stage, F.lit(" status: "), status)
    return named.select(
        *carried,
        "status",
        "stage",
        _text_or_default("_body", "message", message).alias("message"),
        _first_given("_body", REASON_KEYS).alias("reason"),
        _text_or_default("_body", "source", F.lit(DEFAULT_SOURCE)).alias("source"),
        _member("_body", "executionArn").alias("executionArn"),
        _member("_body", "timestamp").alias("timestamp"),
    )
