"""Streams on files: stream equals batch, restarts, late and repeated rows, routing, state."""

import json
import os
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import T0, rows_of
from rillflow.operators.enrich import enrich_events
from rillflow.operators.metrics import metric_change, metric_summary
from rillflow.schemas import ANALYTICS_EVENT, USER_EVENT
from rillflow.sources.topics import parse_json
from rillflow.streaming import io, jobs

AGENTS = ["X Chrome Mobile Safari", "Firefox Tablet", None]


def event(i, sec, user="u", kind="click"):
    return {"user_id": user, "session_id": f"s{i % 4}", "event_type": kind, "event_data": "{}",
            "timestamp": (T0 + timedelta(seconds=sec)).isoformat(timespec="microseconds"),
            "ip_address": "1.1.1.1", "user_agent": AGENTS[i % 3], "page_url": f"https://h/{i}",
            "referrer": None}


def record(value, topic="user_events", offset=0):
    return {"key": "k", "value": value if isinstance(value, str) else json.dumps(value),
            "topic": topic, "partition": 0, "offset": offset, "timestamp": T0.isoformat()}


def put(folder, name, records):
    """One file; files are read in the order of their (here: set) modification times."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))
    when = 1_800_000_000 + len(list(folder.iterdir()))
    os.utime(folder / name, (when, when))


def user_stream(spark, folder, max_files=1):
    return parse_json(io.topic_files(spark, str(folder), ["user_events"], max_files), USER_EVENT)


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    events = [event(i, i * 13) for i in range(30)]
    random.Random(1).shuffle(events)
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(src, "a.json", [record(e) for e in events[:10]])
    put(src, "b.json", [record(e) for e in events[10:20]] + [record(events[0], "other")])

    def run():
        records = io.topic_files(spark, str(src), ["user_events"], 1)
        io.finish(io.to_parquet(jobs.enriched(records, USER_EVENT), out, cp, None))
        return spark.read.parquet(out)

    assert run().count() == 20
    put(src, "c.json", [record(e) for e in events[20:]])
    got = run()
    batch = enrich_events(parse_json(
        spark.createDataFrame([(json.dumps(e),) for e in events], "value string"), USER_EVENT))
    cols = ["timestamp", "session_id", "clean_page_url", "device_type", "browser"]
    assert rows_of(got, *cols) == rows_of(batch, *cols) and got.count() == 30


def test_late_rows(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.json", [record(event(0, 0)), record(event(1, 10800))])
    put(src, "b.json", [record(event(2, 10801))])
    put(src, "c.json", [record(event(3, 9000)), record(event(4, 30))])  # 30 s is beyond the hour
    put(src, "d.json", [record(event(5, 30000))])
    rows = jobs.sliding_counts(user_stream(spark, src), watermark="1 hour", slide_seconds=300)
    io.finish(io.to_parquet(rows, out, str(tmp_path / "cp"), None))
    got = {r.window_start.replace(tzinfo=None): r.n for r in spark.read.parquet(out).collect()}
    assert got == {T0: 1, T0 + timedelta(seconds=9000): 1, T0 + timedelta(seconds=10800): 2}


def test_repeated_rows_are_dropped_across_files(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.json", [record(event(i, i)) for i in range(5)])
    put(src, "b.json", [record(event(i, i)) for i in range(3, 8)])
    rows = jobs.deduplicated(user_stream(spark, src), "1 hour", key="page_url")
    io.finish(io.to_parquet(rows, out, str(tmp_path / "cp"), None))
    assert rows_of(spark.read.parquet(out), "page_url") == [(f"https://h/{i}",) for i in range(8)]


def test_running_counts_over_batches(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(src, "a.json", [record(event(i, i, kind="ab"[i % 2])) for i in range(5)])
    put(src, "b.json", [record(event(i, i, kind="b")) for i in range(4)])

    def run():
        io.finish(io.for_each(jobs.type_counts(user_stream(spark, src)), io.changed_rows(out), cp,
                              "update", None))
        return rows_of(io.current_rows(spark, out, ["event_type"]), "event_type", "n")

    assert run() == [("a", 3), ("b", 6)]
    put(src, "c.json", [record(event(0, 0, kind="c"))])
    assert run() == [("a", 3), ("b", 6), ("c", 1)]


def test_sessions_per_user(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    put(src, "a.json", [record(event(i, i, user="ab"[i % 2])) for i in range(8)])
    put(src, "b.json", [record(event(1, 20000, user="a")), record(event(0, 20001, user="a"))])
    io.finish(io.to_parquet(jobs.new_sessions(user_stream(spark, src), "1 hour"), out,
                            str(tmp_path / "cp"), None))
    assert rows_of(jobs.sessions_per_user(spark.read.parquet(out)), "user_id", "sessions") == [
        ("a", 3), ("b", 2)]
    rough = str(tmp_path / "rough")
    io.finish(io.for_each(jobs.approx_sessions(user_stream(spark, src), "1 hour"),
                          io.changed_rows(rough), str(tmp_path / "cp2"), "update", None))
    assert rows_of(io.current_rows(spark, rough, ["window_start", "user_id"]), "user_id",
                   "sessions") == [("a", 3), ("b", 2)]


METRIC = "id long, metric_name string, metric_value double, timestamp timestamp"


@pytest.mark.parametrize("delay", [0, 3600])
def test_metric_changes_across_batches_equal_batch(spark, tmp_path, delay):
    rnd = random.Random(7)
    rows = [(i, rnd.choice(["m", "m", "n"]), float(rnd.randint(0, 4)), T0 + timedelta(seconds=40 * i))
            for i in range(60)]
    for n in range(5):
        spark.createDataFrame(rows[n * 12:(n + 1) * 12], METRIC).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = io.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], METRIC).schema,
                            max_files=1)
    io.finish(io.for_each(stream, jobs.metric_changes(out, state, str(tmp_path / "late"), delay), str(tmp_path / "cp"),
                          trigger_seconds=None))
    cols = ["id", "previous_value", "is_significant"]
    got = spark.read.parquet(out).fillna(-1.0)
    batch = spark.createDataFrame(rows, METRIC)
    assert got.select("batch").distinct().count() == 5
    assert rows_of(got, *cols) == rows_of(metric_change(batch).fillna(-1.0), *cols)


def test_late_metric_rows_are_judged_or_put_aside(spark, tmp_path):
    out, late = str(tmp_path / "out"), str(tmp_path / "late")
    handle = jobs.metric_changes(out, str(tmp_path / "state"), late, 100)
    row = lambda i, s: (i, "m", float(i), T0 + timedelta(seconds=s))
    handle(spark.createDataFrame([row(i, 10 * i) for i in range(30)], METRIC), 0)
    handle(spark.createDataFrame([row(100, 205), row(101, 15), row(102, 300)], METRIC), 1)
    assert rows_of(spark.read.parquet(f"{out}/batch=1"), "id", "previous_value") == [(100, 20.0), (102, 29.0)]
    assert rows_of(spark.read.parquet(late), "id") == [(101,)]


def test_metric_batch_can_be_repeated(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    handle = jobs.metric_changes(out, state, str(tmp_path / "late"))
    first = spark.createDataFrame([(1, "m", 1.0, T0)], METRIC)
    second = spark.createDataFrame([(2, "m", 3.0, T0 + timedelta(seconds=1))], METRIC)
    handle(first, 0)
    handle(second, 1)
    handle(second, 1)
    assert rows_of(spark.read.parquet(out).fillna(-1.0), "id", "previous_value") == [
        (1, -1.0), (2, 1.0)]


def test_topics_go_to_their_handlers(spark, tmp_path):
    src = tmp_path / "in"
    metric = {"metric_name": "m", "metric_value": 2.5, "dimensions": "{}",
              "timestamp": T0.isoformat(), "source": "x"}
    put(src, "a.json", [record(event(0, 0)), record(metric, "analytics_events"), record("{", "junk")])
    users, metrics = str(tmp_path / "u"), str(tmp_path / "m")
    fn = jobs.routed(
        {"user_events": lambda d: enrich_events(parse_json(d, USER_EVENT)),
         "analytics_events": lambda d: parse_json(d, ANALYTICS_EVENT)},
        {"user_events": io.changed_rows(users), "analytics_events": io.changed_rows(metrics)})
    stream = io.topic_files(spark, str(src), ["user_events", "analytics_events"])
    io.finish(io.for_each(stream, fn, str(tmp_path / "cp"), trigger_seconds=None))
    assert rows_of(spark.read.parquet(users), "device_type") == [("Mobile",)]
    assert rows_of(spark.read.parquet(metrics), "metric_value") == [(2.5,)]


def test_sliding_counts_on_a_batch_frame(make_events):
    got = jobs.sliding_counts(make_events([(0, "a"), (59, "a"), (60, "a")]))
    at = got.where(F.col("window_start") == F.lit(T0).cast("timestamp_ntz")).collect()
    assert [r.n for r in at] == [3] and got.count() == 6


def test_table_stream_reads_files_and_folders(spark, tmp_path):
    rows = spark.range(10)
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.repartition(3).write.parquet(str(tmp_path / "t" / "events.parquet"))
    one = next((tmp_path / "one").glob("part-*.parquet"))
    for i, path in enumerate([str(one), str(tmp_path / "t" / "events.parquet")]):
        out = str(tmp_path / f"out{i}")
        io.finish(io.to_parquet(io.table_stream(spark, path, rows.schema, 1000), out, str(tmp_path / f"cp{i}"), None))
        assert rows_of(spark.read.parquet(out), "id") == [(k,) for k in range(10)]
    with pytest.raises(Exception, match="nowhere"):
        io.table_stream(spark, str(tmp_path / "nowhere"), rows.schema)
