import gzip
import json
import resource
import subprocess
import sys
import textwrap
import zlib

import pytest

from cairn.sources.payloads import array_records


def bare(data):
    engine = zlib.compressobj(wbits=-zlib.MAX_WBITS)
    return engine.compress(data) + engine.flush()


def found(spark, payload, encoding=None):
    df = spark.createDataFrame([(7, bytearray(payload) if payload is not None else None, encoding)], "key int, payload binary, content_encoding string")
    out = array_records(df)
    assert out.columns == ["key", "content_encoding", "record"]
    rows = out.collect()
    assert all(row.key == 7 for row in rows)
    return [row.record for row in rows]


ITEMS = [{"a": 'x,]}"\\', "b": [1, [2, {}], {"c": "}"}]}, {"é": "日本"}, 5, "text, with \"quotes\"", None, [], {}, -1.5e3, True]
ARRAY = json.dumps(ITEMS, ensure_ascii=False)
WAYS = [
    (lambda d: d, None), (lambda d: d, "identity"), (gzip.compress, "gzip"), (gzip.compress, None), (zlib.compress, "deflate"), (zlib.compress, ""),
    (bare, "deflate"), (lambda d: gzip.compress(d[:40]) + gzip.compress(d[40:]) + b"\0\0", "GZIP"),
]


@pytest.mark.parametrize("way", range(len(WAYS)))
def test_elements_of_an_array_however_it_is_packed(spark, way):
    pack, encoding = WAYS[way]
    records = found(spark, pack(ARRAY.encode()), encoding)
    expected = [item if isinstance(item, str | None) else json.dumps(item, ensure_ascii=False) for item in ITEMS]
    assert [r if r is None or isinstance(ITEMS[i], str) else json.loads(r) for i, r in enumerate(records)] == ITEMS
    assert records[3] == expected[3] and records[4] is None


def test_layouts_and_emptiness(spark):
    assert found(spark, json.dumps(ITEMS[:2], indent=2).encode()) != [] and len(found(spark, json.dumps(ITEMS, indent=2).encode())) == len(ITEMS)
    assert found(spark, b" [ ] \n") == [] and found(spark, b"[]") == []
    assert found(spark, b"") == [""] and found(spark, None) == ["undecodable payload: no text"]


@pytest.mark.parametrize("text", ['{"a": 1}', "[1, 2", "[1, 2] x", "[1,,2]", "[1, 2,]", "[1}", "plain, text", "]", "[[1]", '["a', "[1][2]", "5"])
def test_what_is_no_whole_array_is_one_record_with_its_text(spark, text):
    assert found(spark, text.encode()) == [text]
    assert found(spark, gzip.compress(text.encode())) == [text]


def test_what_does_not_decode_is_one_record_that_says_why(spark):
    packed = gzip.compress(json.dumps(list(range(200_000))).encode())
    for payload, encoding in ((packed[:-9], "gzip"), (packed[:1000] + b"!!!!" + packed[1004:], "gzip"), (b"no gzip", "gzip"), (b"\xff\xfe[1]", None), (b'["\xff"]', None)):
        (record,) = found(spark, payload, encoding)
        assert record.startswith("undecodable payload: ")


def test_an_element_that_is_too_large(spark):
    df = spark.createDataFrame([(bytearray(json.dumps(["x" * 3_000_000, 1]).encode()), None)], "payload binary, content_encoding string")
    (row,) = array_records(df, max_record=1_000_000).collect()
    assert row.record == "undecodable payload: NoArray: an element is too large"
    assert len(array_records(df).collect()) == 2


def test_many_payloads_share_batches(spark):
    rows = [(i, bytearray(gzip.compress(json.dumps([{"i": i, "k": k} for k in range(i % 4)]).encode())), "gzip") for i in range(500)]
    out = array_records(spark.createDataFrame(rows, "key int, payload binary, content_encoding string")).collect()
    assert len(out) == sum(i % 4 for i in range(500)) and all(json.loads(row.record)["i"] == row.key for row in out)


def test_an_array_larger_than_the_worker(tmp_path):
    """A gzip array of 400 MB by a process that gets by with 200 MB, interpreter and Arrow included."""
    script = textwrap.dedent(
        """
        import gzip, io, resource, sys
        import pyarrow as pa
        from cairn.sources.payloads import _array_cutter
        element = b'{"name": "' + b"some text, with [signs] " * 80 + b'"}'
        out = io.BytesIO()
        many = 400_000_000 // len(element)
        with gzip.GzipFile(fileobj=out, mode="wb", compresslevel=1) as file:
            file.write(b"[" + element)
            for _ in range(many - 1):
                file.write(b", " + element)
            file.write(b"]")
        batch = pa.RecordBatch.from_arrays([pa.array([out.getvalue()], pa.binary()), pa.array(["gzip"])], ["payload", "content_encoding"])
        del out
        rows = sum(b.num_rows for b in _array_cutter(["content_encoding"], "payload", "content_encoding")([batch]))
        assert rows == many, (rows, many)
        print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
        """
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600, cwd=__file__.rsplit("/tests/", 1)[0])
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 200, done.stdout
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss > 0
