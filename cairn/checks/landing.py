"""Queries over landing, raw reads, payloads and event messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.checks.binding import FLAT_CTE, RAW_CTE, order_objects, order_records
from cairn.checks.registry import query, table
from cairn.functions.values import canonical_json
from cairn.operators import events
from cairn.operators.rules import check, contract_rules
from cairn.operators.sinks import land
from cairn.operators.transforms import flatten
from cairn.plans.medallion import payload_records
from cairn.sources import files
from cairn.sources import payloads as responses
from cairn.sources.records import parse_records, read_records, scan_arrays, to_records
from cairn.streaming.events import read_events, run_event_stream
from cairn.workspace import scratch_path

RAW_COLUMNS_ORACLE = f"""WITH {RAW_CTE} SELECT common AS country_name, official AS official_name, region, subregion,
    population, area, capital, currencies FROM raw"""
ALL_RECORDS_PER_ARRAY = 1000


def leaves(parsed: DataFrame, *more: Column) -> DataFrame:
    """All fields of parsed records, nested ones as text."""
    return parsed.select(
        F.col("name.common").alias("country_name"),
        F.col("name.official").alias("official_name"),
        "region",
        "subregion",
        F.col("population").cast("double").cast("bigint").alias("population"),
        F.col("area").cast("double").alias("area"),
        F.to_json("capital").alias("capital"),
        canonical_json(F.col("currencies")).alias("currencies"),
        *more,
    )


def _valid(records: DataFrame) -> DataFrame:
    return check(parse_records(records), contract_rules()).where("verdict = 'valid'")


def _array_texts(spark: SparkSession, sf_dir: str, indented: bool) -> DataFrame:
    """Arrays of at most a thousand records each, as the key is unique: by runs of a thousand keys."""
    record, joined, ends = F.col("record"), ",", ("[", "]")
    if indented:
        # One field per line, two levels deep, as the landed files are laid out.
        record, joined, ends = F.concat(F.lit("  {\n    "), F.substr(record, F.lit(2), F.length(record) - 2), F.lit("\n  }")), ",\n", ("[\n", "\n]")
    block = F.floor(F.col("o_orderkey") / ALL_RECORDS_PER_ARRAY).alias("block")
    texts = order_objects(spark, sf_dir).groupBy(block).agg(F.collect_list(record).alias("records"))
    return texts.select(F.concat(F.lit(ends[0]), F.array_join("records", joined), F.lit(ends[1])).alias("value"))


def _write_array_files(spark: SparkSession, sf_dir: str, indented: bool) -> str:
    path = scratch_path(spark, "arrays")
    _array_texts(spark, sf_dir, indented).write.option("maxRecordsPerFile", 1).text(path)
    return path


@query(RAW_COLUMNS_ORACLE)
def json_land_and_read(spark, sf_dir):
    landed = land(order_records(spark, sf_dir), scratch_path(spark, "raw"), "20240131_000000")
    return leaves(parse_records(read_records(spark, landed.path)))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def land_columnar(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    landed = land(to_records(customers), scratch_path(spark, "raw"), "20240131_000000")
    return read_records(spark, landed.path).select(F.from_json("record", customers.schema).alias("row")).select("row.*")


@query(RAW_COLUMNS_ORACLE)
def json_array_scan(spark, sf_dir):
    return leaves(scan_arrays(spark, _write_array_files(spark, sf_dir, indented=False)))


@query(RAW_COLUMNS_ORACLE)
def json_array_records(spark, sf_dir):
    return leaves(parse_records(read_records(spark, _write_array_files(spark, sf_dir, indented=False), "whole")))


@query(RAW_COLUMNS_ORACLE)
def json_indented_records(spark, sf_dir):
    return leaves(parse_records(read_records(spark, _write_array_files(spark, sf_dir, indented=True), "indented")))


@query(
    f"""WITH {RAW_CTE}, judged AS (
      SELECT k, CASE WHEN k % 23 = 0 OR k % 29 = 0 THEN 'readable' ELSE concat_ws(',',
        CASE WHEN NOT has_name THEN 'name_required' END,
        CASE WHEN population IS NULL THEN 'population_required' END,
        CASE WHEN region IS NULL THEN 'region_required' END,
        CASE WHEN population IS NULL OR population <= 0 THEN 'population_min' END) END AS reasons FROM raw)
    SELECT k, CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS verdict, reasons, true AS same_text FROM judged"""
)
def quarantine(spark, sf_dir):
    """Every record with its verdict, its reasons, and its own text, also where that is no JSON."""
    key, record = F.col("o_orderkey"), F.col("record")
    keyed = F.concat(F.lit('{"key":'), key, F.lit(","), F.substr(record, F.lit(2)))
    cut_short = F.substr(keyed, F.lit(1), F.length(keyed) - 1)
    untyped = F.concat(F.lit('{"name":"plain","capital":"none",'), F.substr(keyed, F.lit(2)))
    broken = F.when(key % 23 == 0, cut_short).when(key % 29 == 0, untyped).otherwise(keyed)
    records = order_objects(spark, sf_dir).select(key.alias("k"), broken.alias("record"))
    landed = land(records.select("record"), scratch_path(spark, "raw"), "20240131_000000")
    checked = check(parse_records(read_records(spark, landed.path)), contract_rules())
    read = checked.select(
        F.regexp_extract("record", '"key":([0-9]+)', 1).cast("bigint").alias("k"), "verdict",
        F.coalesce(F.array_join("reasons", ","), F.lit("")).alias("reasons"), F.col("record").alias("kept"),
    )
    return read.join(records, "k").select("k", "verdict", "reasons", (F.col("kept") == F.col("record")).alias("same_text"))


def _payloads(spark: SparkSession, sf_dir: str, texts: DataFrame) -> DataFrame:
    """``key`` and ``text`` packed in every way a response may come, as ``key % 7`` says; 6 is an empty body.

    Row by row, a hundred to a worker at once: a batch of ten thousand texts is much to hold beside the decoder's.
    """

    def packed(key, text):
        import gzip
        import zlib

        data = text.encode("utf-8")
        bare = zlib.compressobj(wbits=-zlib.MAX_WBITS)
        ways = {
            0: lambda: gzip.compress(data),
            1: lambda: zlib.compress(data),
            2: lambda: bare.compress(data) + bare.flush(),
            3: lambda: gzip.compress(data),
            4: lambda: zlib.compress(data),
            5: lambda: data,
            6: lambda: b"",
        }
        return ways[key % 7]()

    declared = F.element_at(F.array(*map(F.lit, ("GZIP", "deflate", "deflate", None, "", "identity", "gzip"))), (F.pmod("key", F.lit(7)) + 1).cast("int"))
    payload = F.udf(packed, "binary", useArrow=False)("key", "text")
    return texts.select(F.col("key").cast("bigint").alias("key"), payload.alias("payload"), declared.alias("content_encoding"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 7 = 6 THEN '' ELSE text END AS text, CAST(NULL AS VARCHAR) AS decode_error
    FROM documents"""
)
def decode_payloads(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    decoded = responses.decode_payloads(_payloads(spark, sf_dir, texts))
    return decoded.select(F.col("key").alias("doc_id"), "text", "decode_error")


@query(f"WITH {FLAT_CTE} SELECT country_name, region, subregion, population FROM flat")
def payloads_to_records(spark, sf_dir):
    """Compressed responses, one array each, to validated records."""
    arrays = _array_texts(spark, sf_dir, indented=False).select(
        (F.pmod(F.xxhash64("value"), F.lit(6))).alias("key"), F.col("value").alias("text")
    )
    records = payload_records(responses.decode_payloads(_payloads(spark, sf_dir, arrays)))
    return flatten(_valid(records)).select("country_name", "region", "subregion", "population")


@query(
    """SELECT CASE WHEN event_type IN ('click', 'view') THEN '20240101_000000' ELSE '20240102_000000' END AS run_ts,
      count(*) AS n_records, CAST(sum(strlen(props)) AS BIGINT) AS n_bytes FROM events GROUP BY 1"""
)
def landed_sizes(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select(F.col("props").alias("record"), "event_type")
    seen, zone = F.col("event_type").isin("click", "view"), scratch_path(spark, "raw")
    land(messages.where(seen), zone, "20240101_000000")
    land(messages.where(~seen), zone, "20240102_000000")
    return files.landed_sizes(spark.read.text(zone), "run_ts")


CUSTOMER_ORACLE = "SELECT c_custkey, c_name, '{}' AS source_status FROM customer"


@query(CUSTOMER_ORACLE.format("fallback"))
def source_fallback(spark, sf_dir):
    """Nothing was landed for the run, so the records kept from before stand in."""
    zone = scratch_path(spark, "raw")
    kept = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    landed = read_records(spark, zone) if files.has_landed(spark, zone) else None
    return files.source_or_fallback(landed, kept)


@query(CUSTOMER_ORACLE.format("success"))
def source_primary(spark, sf_dir):
    kept = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    landed = land(to_records(kept), scratch_path(spark, "raw"), "20240131_000000").path
    records = read_records(spark, landed) if files.has_landed(spark, landed) else None
    rows = records.select(F.from_json("record", kept.schema).alias("row")).select("row.*")
    return files.source_or_fallback(rows, kept.limit(0))


JOB_MESSAGES = """CASE event_id % 8
    WHEN 0 THEN '{"jobName": "' || event_type || '"}'
    WHEN 1 THEN '{"JobName": "' || event_type || '"}'
    WHEN 2 THEN '{"jobName": "", "job_name": "' || event_type || '"}'
    WHEN 3 THEN '{"job_name": "late", "JobName": "' || event_type || '", "jobName": null}'
    WHEN 4 THEN props
    WHEN 5 THEN 'oops ' || event_type
    WHEN 6 THEN '["' || event_type || '"]'
    ELSE '{"jobName": 0, "JobName": false, "job_name": []}' END"""
GIVEN = """CASE WHEN CAST(json_extract({0}, '$.{1}') AS VARCHAR) NOT IN ('""', '0', 'false', 'null', '{{}}', '[]')
    THEN json_extract_string({0}, '$.{1}') END"""


@query(
    f"""WITH messages AS (SELECT event_id, {JOB_MESSAGES} AS body FROM events),
    objects AS (SELECT event_id, CASE WHEN json_valid(body) THEN CASE WHEN json_type(body) = 'OBJECT' THEN body ELSE '{{}}' END
      ELSE '{{}}' END AS body FROM messages)
    SELECT event_id, coalesce({GIVEN.format("body", "jobName")}, {GIVEN.format("body", "JobName")},
      {GIVEN.format("body", "job_name")}, 'validation') AS job_name FROM objects"""
)
def event_field(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select("event_id", F.expr(JOB_MESSAGES).alias("body"))
    return events.event_field(messages, "body", "job_name", "validation").drop("body")


STATUS_MESSAGES = """CASE event_id % 6
    WHEN 0 THEN '{"status": "SUCCEEDED", "stage": "' || event_type || '", "message": "run ' || event_id || '", "source": "cron"}'
    WHEN 1 THEN '{"status": "outer", "Payload": {"status": "FAILED", "error": "code ' || event_id || '", "stage": "' || event_type || '"}}'
    WHEN 2 THEN '{"status": null, "stage": "' || event_type || '", "source": null}'
    WHEN 3 THEN '{"Payload": ' || props || '}'
    WHEN 4 THEN '{"reason": "", "error": null, "failureReason": "user ' || user_id || '", "executionArn": "run:' || event_id || '", "timestamp": "t' || event_id || '"}'
    ELSE 'not json ' || event_type END"""


@query(
    f"""WITH messages AS (SELECT event_id, {STATUS_MESSAGES} AS body FROM events),
    outers AS (SELECT event_id, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS body FROM messages),
    opened AS (SELECT event_id, CASE WHEN json_exists(body, '$.Payload') THEN CAST(json_extract(body, '$.Payload') AS VARCHAR)
      ELSE body END AS body FROM outers),
    named AS (SELECT event_id, body,
      CASE WHEN json_exists(body, '$.status') THEN json_extract_string(body, '$.status') ELSE 'UNKNOWN' END AS status,
      CASE WHEN json_exists(body, '$.stage') THEN json_extract_string(body, '$.stage') ELSE 'pipeline' END AS stage
      FROM opened)
    SELECT event_id, status, stage,
      CASE WHEN json_exists(body, '$.message') THEN json_extract_string(body, '$.message')
        ELSE coalesce(stage, 'None') || ' status: ' || coalesce(status, 'None') END AS message,
      coalesce({GIVEN.format("body", "reason")}, {GIVEN.format("body", "error")}, {GIVEN.format("body", "failureReason")}) AS reason,
      CASE WHEN json_exists(body, '$.source') THEN json_extract_string(body, '$.source') ELSE 'stepfunctions' END AS source,
      json_extract_string(body, '$.executionArn') AS "executionArn",
      json_extract_string(body, '$.timestamp') AS "timestamp" FROM named"""
)
def event_normalise(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select("event_id", F.expr(STATUS_MESSAGES).alias("body"))
    return events.normalise_events(messages, "body")


CONSERVED = f"""
WITH {RAW_CTE}, cases AS (
    SELECT 'text' AS origin, doc_id AS k, 'rejected' AS verdict, sha256(coalesce(text, 'null')) AS digest FROM documents
    UNION ALL SELECT 'record', k, CASE WHEN has_name AND region IS NOT NULL AND population > 0 THEN 'valid' ELSE 'rejected' END, NULL FROM raw
    UNION ALL SELECT 'payload', doc_id, 'rejected', NULL FROM documents WHERE doc_id % 3 = 0
)
SELECT origin, verdict, count(*) AS n_records, count(DISTINCT k) AS n_keys, bool_and(digest IS NOT NULL) AS all_texts FROM cases GROUP BY 1, 2
"""


@query(CONSERVED)
def conservation(spark, sf_dir):
    """Whatever is landed is read again, as one valid or one rejected row: whole document texts, records, and payloads that do not decode.

    Documents are found again by their whole text; a text that is not kept loses its row in the join."""
    documents = table(spark, sf_dir, "documents")
    zone = scratch_path(spark, "raw")
    keyed = F.concat(F.lit('{"key":'), "o_orderkey", F.lit(","), F.substr("record", F.lit(2))).alias("record")
    cut = documents.where("doc_id % 3 = 0").select(
        "doc_id", F.concat(F.unhex(F.lit("1f8b08")), F.encode(F.concat(F.lit("payload "), "doc_id"), "utf-8")).alias("payload"), F.lit("gzip").alias("content_encoding")
    )
    undecoded = payload_records(responses.decode_payloads(cut)).select("record")
    for run_ts, records in (("text", documents.select(F.col("text").alias("record"))), ("record", order_objects(spark, sf_dir).select(keyed)), ("payload", undecoded)):
        land(records, zone, run_ts)
    checked = check(parse_records(read_records(spark, zone)), contract_rules())
    read = checked.select(F.regexp_extract("file_path", "run_ts=([a-z]+)", 1).alias("origin"), "verdict", "record")
    # rows that share a text are told apart by their number
    texts = documents.select("doc_id", F.col("text").alias("record")).groupBy("record").agg(F.collect_list("doc_id").alias("ids"))
    kept = read.where("origin = 'text'").groupBy("origin", "verdict", "record").agg(F.count(F.lit(1)).alias("n"))
    found = kept.join(texts, kept["record"].eqNullSafe(texts["record"])).where(F.size("ids") == F.col("n")).select("origin", "verdict", F.explode("ids").alias("k"))
    others = read.where("origin <> 'text'")
    keys = F.when(F.col("origin") == "record", F.regexp_extract("record", '"key":([0-9]+)', 1).try_cast("bigint")).otherwise(F.monotonically_increasing_id())
    every = found.unionByName(others.select("origin", "verdict", keys.alias("k")))
    return every.groupBy("origin", "verdict").agg(
        F.count(F.lit(1)).alias("n_records"), F.countDistinct("k").alias("n_keys"), (F.max("origin") == "text").alias("all_texts")
    )


@query(f"WITH {FLAT_CTE} SELECT * FROM flat")
def array_payload_records(spark, sf_dir):
    """Compressed responses, cut into records while they are inflated."""
    arrays = _array_texts(spark, sf_dir, indented=True).select((F.pmod(F.xxhash64("value"), F.lit(6))).alias("key"), F.col("value").alias("text"))
    records = responses.array_records(_payloads(spark, sf_dir, arrays))
    return flatten(_valid(records.select("record", F.lit(None).cast("string").alias("file_path"))))


@query(
    f"""WITH messages AS (SELECT event_id, {STATUS_MESSAGES} AS body FROM events),
    outers AS (SELECT event_id, body AS given, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS body FROM messages),
    opened AS (SELECT event_id, given, body AS outer_body, CASE WHEN json_exists(body, '$.Payload') THEN CAST(json_extract(body, '$.Payload') AS VARCHAR)
      ELSE body END AS body FROM outers),
    named AS (SELECT event_id, body,
      CASE WHEN json_exists(body, '$.status') THEN json_extract_string(body, '$.status') ELSE 'UNKNOWN' END AS status,
      CASE WHEN json_exists(body, '$.stage') THEN json_extract_string(body, '$.stage') ELSE 'pipeline' END AS stage
      FROM opened)
    SELECT status, stage,
      CASE WHEN json_exists(body, '$.message') THEN json_extract_string(body, '$.message')
        ELSE coalesce(stage, 'None') || ' status: ' || coalesce(status, 'None') END AS message,
      coalesce({GIVEN.format("body", "reason")}, {GIVEN.format("body", "error")}, {GIVEN.format("body", "failureReason")}) AS reason,
      CASE WHEN json_exists(body, '$.source') THEN json_extract_string(body, '$.source') ELSE 'stepfunctions' END AS source,
      json_extract_string(body, '$.executionArn') AS "executionArn", json_extract_string(body, '$.timestamp') AS "timestamp",
      'unknown' AS job_name, CASE WHEN event_id % 5 < 3 THEN 1 ELSE 2 END AS trigger_number FROM named"""
)
def event_stream(spark, sf_dir):
    """Status messages land in two drops, a run after each; every message is there once, by the run after its drop."""
    root = scratch_path(spark, "events")
    landed, target, seen = f"{root}/landed", f"{root}/normalised", None
    first = F.col("event_id") % 5 < 3
    for drop in (first, ~first):
        messages = table(spark, sf_dir, "events").where(drop).select(F.expr(STATUS_MESSAGES).alias("value"))
        messages.write.mode("append").text(landed)
        run_event_stream(spark, landed, target, f"{root}/checkpoint")
        if seen is None:
            seen = spark.createDataFrame(read_events(spark, target).select("landed_in").distinct().collect(), "landed_in string")
    found = read_events(spark, target).join(F.broadcast(seen.withColumn("early", F.lit(1))), "landed_in", "left")
    return found.withColumn("trigger_number", F.coalesce("early", F.lit(2))).drop("landed_in", "early")
