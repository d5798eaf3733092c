import json
import os

from cairn.streaming.events import normalised, read_event_stream, read_events, run_event_stream

MESSAGES = [
    {"status": "SUCCEEDED", "stage": "validate", "jobName": "one"}, {"Payload": {"status": "FAILED", "error": "no", "source": None}, "job_name": "two"},
    {"status": None, "timestamp": "t"}, "oops", [1], {}, {"status": "FAILED", "reason": "", "failureReason": "late", "JobName": 0},
]


def drop(folder, name, messages):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages) + "\n\n  \n")


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def test_every_event_is_appended_once(spark, tmp_path):
    landed, target, checkpoint = tmp_path / "landed", str(tmp_path / "events"), str(tmp_path / "checkpoint")
    drop(landed, "1.txt", MESSAGES[:3])
    run_event_stream(spark, str(landed), target, checkpoint)
    first = rows(read_events(spark, target))
    assert len(first) == 3
    drop(landed, "2.txt", MESSAGES[3:])
    drop(landed, "3.txt", MESSAGES[:1])
    query = run_event_stream(spark, str(landed), target, checkpoint, max_files=1)
    assert sum(progress["numInputRows"] for progress in query.recentProgress) > 0
    found = read_events(spark, target)
    texts = [m if isinstance(m, str) else json.dumps(m) for m in [*MESSAGES, MESSAGES[0]]]
    batch = normalised(spark.createDataFrame([(text,) for text in texts], "body string"))
    assert rows(found.drop("landed_in")) == rows(batch.select(*[name for name in found.columns if name != "landed_in"]))
    assert sorted({row.landed_in for row in found.collect()}) == ["1.txt", "2.txt", "3.txt"]
    run_event_stream(spark, str(landed), target, checkpoint)
    assert read_events(spark, target).count() == len(texts) and set(first) < set(rows(read_events(spark, target)))


def test_a_trigger_that_failed_leaves_nothing_twice(spark, tmp_path):
    landed, target, checkpoint = tmp_path / "landed", str(tmp_path / "events"), str(tmp_path / "checkpoint")
    drop(landed, "1.txt", MESSAGES)
    run_event_stream(spark, str(landed), target, checkpoint)
    # the batch was written, and the run died before it was committed
    commit = os.path.join(checkpoint, "commits", "0")
    os.replace(commit, str(tmp_path / "lost"))
    crc = os.path.join(checkpoint, "commits", ".0.crc")
    if os.path.exists(crc):
        os.replace(crc, str(tmp_path / "lost.crc"))
    run_event_stream(spark, str(landed), target, checkpoint)
    assert spark.read.parquet(target).count() == len(MESSAGES)
    assert read_event_stream(spark, str(landed)).isStreaming
