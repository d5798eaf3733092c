import gzip
import json
import zlib
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cairn.checks import landing
from cairn.operators.events import event_field, normalise_events
from cairn.plans.medallion import payload_records
from cairn.sources import payloads as payloads_module
from cairn.sources.payloads import decode_payloads

TEXT = json.dumps([{"name": "ü", "n": 1}, {"name": "b"}], ensure_ascii=False)
BYTES = TEXT.encode("utf-8")


def bare_deflate(data):
    packer = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return packer.compress(data) + packer.flush()


def payloads(spark, *rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "id int, payload binary, content_encoding string")


def test_every_encoding(spark):
    rows = [
        (gzip.compress(BYTES), "gzip"),
        (gzip.compress(BYTES), "x-GZip"),
        (zlib.compress(BYTES), "deflate"),
        (bare_deflate(BYTES), "Deflate"),
        (gzip.compress(BYTES), None),
        (zlib.compress(BYTES), ""),
        (BYTES, "identity"),
    ]
    decoded = decode_payloads(payloads(spark, *rows)).orderBy("id").collect()
    assert [row.text for row in decoded] == [TEXT] * 7
    assert {row.decode_error for row in decoded} == {None}
    assert decode_payloads(payloads(spark, (b"", "gzip"), (None, None))).select("text").collect() == [("",), ("",)]


def test_a_broken_payload_costs_itself_only(spark):
    rows = [(b"not gzip", "gzip"), (gzip.compress(BYTES)[:-9], None), (b"\xff\xfe", None), (b"junk", "deflate"), (BYTES, None)]
    decoded = decode_payloads(payloads(spark, *rows)).orderBy("id").collect()
    assert [row.text for row in decoded] == [None] * 4 + [TEXT]
    assert all(row.decode_error for row in decoded[:4]) and decoded[4].decode_error is None


def test_growing_batches_are_handed_over_in_slices(spark, monkeypatch):
    monkeypatch.setattr(payloads_module, "FLUSH_BYTES", 10)
    rows = [(gzip.compress(bytes([65 + i]) * (3 * i)), None) for i in range(20)]
    decoded = decode_payloads(payloads(spark, *rows).coalesce(1)).orderBy("id").collect()
    assert [row.text for row in decoded] == [chr(65 + i) * (3 * i) for i in range(20)]
    assert [row.id for row in decoded] == list(range(20))


def test_a_worker_holds_few_of_the_texts_it_unpacked():
    """64 MB of text out of one small batch leave the worker a few megabytes at a time."""
    schema = T.StructType([T.StructField("payload", T.BinaryType()), T.StructField("content_encoding", T.StringType())])
    work = decode_payloads(SimpleNamespace(schema=schema, mapInArrow=lambda work, _: work))
    packed = pa.RecordBatch.from_arrays([pa.array([gzip.compress(b"x" * (1 << 20))] * 64), pa.array(["gzip"] * 64)], schema.fieldNames())
    sizes = [(batch.num_rows, batch.nbytes) for batch in work([packed])]
    assert sum(rows for rows, _ in sizes) == 64 and max(held for _, held in sizes) < 8 << 20


def test_packing_takes_no_arrow_batches(spark):
    """Rows come to the packing worker by the hundred, not in batches of ten thousand; every way is unpacked again."""
    texts = spark.createDataFrame([(key, f"text {key}") for key in range(14)], "key bigint, text string")
    packed = landing._payloads(spark, "", texts)
    assert "MapInArrow" not in packed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, decode_payloads(packed).select("key", "text").collect())) == [(key, "" if key % 7 == 6 else f"text {key}") for key in range(14)]
    assert {row.key % 7: row.content_encoding for row in packed.collect()} == {0: "GZIP", 1: "deflate", 2: "deflate", 3: None, 4: "", 5: "identity", 6: "gzip"}


def test_payloads_to_records(spark):
    found = payload_records(decode_payloads(payloads(spark, (gzip.compress(BYTES), None), (b"x", "gzip"), (b"[]", None))))
    error = "undecodable payload: EOFError: compressed data ends early"
    assert sorted(row.record for row in found.collect()) == sorted([error, '{"name":"b"}', '{"name":"ü","n":1}'])


def test_gzip_members_and_pieces_are_unpacked(spark):
    long = b"0123456789" * 400_000
    found = decode_payloads(payloads(spark, (gzip.compress(b"a") + gzip.compress(b"b") + b"\0\0", None), (gzip.compress(long, 1), "gzip"), (gzip.compress(long)[:-9], "gzip")))
    rows = found.select("text", "decode_error").collect()
    assert rows[0]["text"] == "ab" and rows[1]["text"] == long.decode() and rows[2]["text"] is None and rows[2]["decode_error"]


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"jobName": "a", "JobName": "b"}', "a"),
        ('{"JobName": "b"}', "b"),
        ('{"job_name": "c"}', "c"),
        ('{"jobName": "", "job_name": "c"}', "c"),
        ('{"jobName": null, "JobName": 0, "job_name": "c"}', "c"),
        ('{"jobName": "0"}', "0"),
        ('{"jobName": "false"}', "false"),
        ('{"jobName": 7}', "7"),
        ('{"jobName": {}}', "default"),
        ('{"jobName": "x", "jobName": "y"}', "y"),
        ("{}", "default"),
        ("oops", "default"),
        ("[1]", "default"),
        ('"jobName"', "default"),
        (None, "default"),
    ],
)
def test_event_field(spark, body, expected):
    frame = spark.createDataFrame([(body,)], "body string")
    assert event_field(frame, "body", "job", "default").first().job == expected


@pytest.mark.parametrize(
    "body, expected",
    [
        ({}, {"status": "UNKNOWN", "stage": "pipeline", "message": "pipeline status: UNKNOWN", "source": "stepfunctions"}),
        ({"status": "OK", "stage": "s"}, {"status": "OK", "message": "s status: OK", "reason": None}),
        ({"status": None}, {"status": None, "message": "pipeline status: None"}),
        ({"message": None, "source": None}, {"message": None, "source": None}),
        ({"Payload": {"status": "in"}, "status": "out"}, {"status": "in"}),
        ({"reason": "", "error": "e", "failureReason": "f"}, {"reason": "e"}),
        ({"reason": False, "error": [], "failureReason": "f"}, {"reason": "f"}),
        ({"error": {"Cause": "c"}}, {"reason": '{"Cause":"c"}'}),
        ({"executionArn": "arn", "timestamp": "t"}, {"executionArn": "arn", "timestamp": "t"}),
        ("oops", {"status": "UNKNOWN", "stage": "pipeline"}),
    ],
)
def test_normalise_events(spark, body, expected):
    text = body if isinstance(body, str) else json.dumps(body)
    row = normalise_events(spark.createDataFrame([(1, text)], "id int, body string"), "body").first().asDict()
    assert {name: row[name] for name in expected} == expected
    assert row["id"] == 1 and "body" not in row
