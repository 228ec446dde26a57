"""One write per batch to several outputs: both or neither, over restarts and repeats; run metrics."""

import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, rows_of
from rillflow.config import Settings
from rillflow.operators.enrich import broken_payloads, purchase_payload
from rillflow.operators.metrics import alerts, run_measures
from rillflow.schemas import USER_EVENT
from rillflow.sources.topics import check_messages
from rillflow.streaming import commits, io, jobs
from rillflow.streaming.progress import ProgressLog, progress_measures
from test_streaming import event, put, record, user_stream


def start(spark, src, sinks, max_files=1):
    stream = io.topic_files(spark, str(src), ["user_events", "other"], max_files)
    io.finish(jobs.run_stream(stream, sinks, Settings(), once=True))


def outputs(spark, sinks):
    good = sinks.read(spark, "events", jobs.event_output(USER_EVENT))
    bad = sinks.read(spark, "dead_letters", jobs.DEAD_LETTERS)
    return good, bad


def test_good_and_broken_records_add_up_over_restarts(spark, tmp_path):
    src, sinks = tmp_path / "in", jobs.quarantined(str(tmp_path / "out"), USER_EVENT, ["user_events"])
    put(src, "a.json", [record(event(i, i), offset=i) for i in range(5)] + [record("{cut", offset=5), record("[1]", offset=6)])
    put(src, "b.json", [record(event(7, 7), "other", offset=7), record({**event(8, 8), "timestamp": "soon"}, offset=8)])
    start(spark, src, sinks)
    put(src, "c.json", [record(event(i, i), offset=i) for i in (9, 10)] + [record("", offset=11), record({}, offset=12)])
    start(spark, src, jobs.quarantined(str(tmp_path / "out"), USER_EVENT, ["user_events"]))
    good, bad = outputs(spark, sinks)
    assert good.count() == 8 and good.where("device_type = 'Mobile'").count() > 0
    assert rows_of(bad, "offset", "reason") == [(5, "bad message"), (6, "bad message"), (7, "unknown topic"),
                                                (8, "bad message"), (11, "bad message")]
    assert {r.value for r in bad.collect()} >= {"{cut", "[1]", ""}
    counts = sinks.commits(spark, jobs.MEASURED).agg(F.sum("rows"), F.sum("rows_events"), F.sum("rows_dead_letters")).first()
    assert tuple(counts) == (13, 8, 5)


def test_a_failed_or_repeated_batch_shows_both_outputs_or_none(spark, tmp_path, monkeypatch):
    sinks = jobs.quarantined(str(tmp_path / "out"), USER_EVENT, ["user_events"])
    rows = [record(event(0, 0)), record("broken")]
    batch = spark.createDataFrame([(r["key"], r["value"], r["topic"]) for r in rows], "key string, value string, topic string")
    sinks.write(batch, 0)
    put_once = commits.put_once
    monkeypatch.setattr(commits, "put_once", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sinks.write(batch, 1)  # the data is there, the record is not
    monkeypatch.setattr(commits, "put_once", put_once)
    assert [d.count() for d in outputs(spark, sinks)] == [1, 1]
    sinks.write(batch, 1)
    sinks.write(batch, 1)
    sinks.write(batch, 0)
    assert [d.count() for d in outputs(spark, sinks)] == [2, 2]
    assert sinks.clean(spark) == 1 and sinks.clean(spark) == 0
    assert [d.count() for d in outputs(spark, sinks)] == [2, 2]
    assert not put_once(spark, f"{sinks.root}/commits/{0:020d}.json", "{}") and sinks.commits(spark).count() == 2


def test_batches_without_rows_of_one_kind(spark, tmp_path):
    sinks = jobs.quarantined(str(tmp_path / "out"), USER_EVENT, ["user_events"], clock="2024-01-01 01:00:00")
    kinds = "key string, value string, topic string"
    sinks.write(spark.createDataFrame([], kinds), 0)
    sinks.write(spark.createDataFrame([("k", json.dumps(event(0, 10, kind="error")), "user_events")], kinds), 1)
    good, bad = outputs(spark, sinks)
    assert good.count() == 1 and bad.count() == 0
    got = {r.metric: (r.num, r.den) for r in alerts(run_measures(sinks.commits(spark, jobs.MEASURED), 1)).collect()}
    assert got == {"error_rate": (1, 1), "processing_lag_seconds": (3590, 1), "utilization": (1, 1)}


def test_messages_are_checked_by_type(spark):
    schema = "a tinyint, b string, c array<int>, d struct<x: double>"
    values = ['{"a": 127, "b": "x"}', '{"a": 128}', '{"a": "x"}', '{"a": null}', '{"c": [1, 2], "d": {"x": 1.5}}', '{"c": 5}',
              "5", "null", None, '{"a": 1} extra', '{"extra": 1}']
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    kind = spark.createDataFrame([], schema).schema
    got = {r.i: r for r in check_messages(df, kind).collect()}
    assert [got[i].reason is None for i in range(len(values))] == [
        True, False, False, True, True, False, False, False, False, True, True]
    assert got[4].data.c == [1, 2] and got[4].data.d.x == 1.5 and got[0].data.a == 127


def test_broken_payloads(spark):
    df = spark.createDataFrame([(1, "purchase", '{"total_amount": 5.5}'), (2, "purchase", "{cut"), (3, "purchase", None),
                                (4, "view", '{"items_count": "x"}')], "id long, event_type string, event_data string")
    assert [r.id for r in broken_payloads(df).collect()] == [2]
    assert rows_of(purchase_payload(df), "id", "total_amount", "items_count") == [(1, 5.5, 0), (2, 0.0, 0), (3, 0.0, 0)]


def test_progress_reports_become_measures(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.json", [record(event(0, 0)), record(event(1, 10800))])
    put(src, "b.json", [record(event(2, 10801))])
    put(src, "c.json", [record(event(3, 9000)), record(event(4, 30))])
    log = ProgressLog(trigger_seconds=60)
    spark.streams.addListener(log)
    try:
        settings = Settings(window_duration=300, slide_duration=300)
        rows = jobs.configured_counts(user_stream(spark, src), settings)
        io.finish(io.to_parquet(rows, out, str(tmp_path / "cp"), None))
        for _ in range(100):
            if any(r[1] == "late_rows" and r[2] for r in log.rows):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    got = log.frame(spark)
    assert got.where("metric = 'late_rows'").agg(F.sum("num")).first()[0] == 1
    assert got.where("metric = 'utilization' and den = 60000 and num > 0").count() >= 3
    assert got.where("metric = 'processing_lag_seconds' and num > 300").count() >= 3
    fired = {r.metric for r in alerts(got).collect()}
    assert {"late_rows", "processing_lag_seconds"} <= fired
    width = spark.read.parquet(out).selectExpr("unix_seconds(window_end) - unix_seconds(window_start) w").distinct().collect()
    assert [r.w for r in width] == [300]


def test_progress_without_event_time():
    assert progress_measures({"timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 0}, 60) == []
    at = datetime.fromisoformat("2024-01-01T00:00:00+00:00")
    assert progress_measures({"timestamp": "2024-01-01T00:00:00.000Z", "numInputRows": 4, "durationMs": {"triggerExecution": 54_000},
                              "eventTime": {"max": "2023-12-31T23:50:00.000Z"}}, 60) == [
        (at, "utilization", 54_000, 60_000), (at, "processing_lag_seconds", 600, 1), (at, "late_rows", 0, 4)]


def test_sessions_per_window_in_one_query(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    day = 86400
    put(src, "a.json", [record(event(i, i * 60, user="ab"[i % 2])) for i in range(8)])
    put(src, "b.json", [record(event(i, i * 61 + 40000, user="ab"[i % 2])) for i in range(8)])  # the same sessions again
    put(src, "c.json", [record(event(0, day + 5, user="a")), record(event(1, 50000, user="b"))])  # next day; late but in time
    put(src, "d.json", [record(event(1, 9 * day, user="z"))])
    put(src, "e.json", [record(event(1, 10 * day, user="z"))])
    rows = jobs.session_counts(user_stream(spark, src), day, day)
    io.finish(io.to_parquet(rows, out, str(tmp_path / "cp"), None))
    got = {(r.window_start.replace(tzinfo=None), r.user_id): r.sessions for r in spark.read.parquet(out).collect()}
    assert got == {(T0, "a"): 2, (T0, "b"): 2, (T0 + timedelta(days=1), "a"): 1}
