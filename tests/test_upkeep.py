"""Views kept from daily parts, versions, partitions by folder, headers, sizes, ordered funnel."""

import os
import random
import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import SF, T0, rows_of
from rillflow.config import Settings
from rillflow.operators import quality as Q
from rillflow.operators.product import ordered_steps
from rillflow.plans.registry import _daily_merge, _daily_parts
from rillflow.sources import files, model, topics, warehouse


def plain_steps(kinds, types):
    at = 0
    for k in kinds:
        if at < len(types) and k == types[at]:
            at += 1
    return at


@pytest.mark.parametrize("size", [1_000_000, 60_000_000, 3_600_000_000])
def test_ordered_steps_equal_a_walk(make_events, size):
    rnd, rows = random.Random(size), []
    for u in range(25):
        for _ in range(rnd.randint(1, 30)):
            rows.append((rnd.choice([rnd.uniform(0, 300), 60, 61]), f"u{u}" if u else None, rnd.choice("abcdx")))
    e = make_events(rows)
    got = {r.user_id: r.reached for r in ordered_steps(e, list("abcd"), ["user_id"], size=size).collect()}
    by = {}
    for i, (t, u, k) in sorted(enumerate(rows), key=lambda x: (round(x[1][0] * 1e6), x[0])):
        if k in "abcd":
            by.setdefault(u, []).append(k)
    assert got == {u: plain_steps(ks, "abcd") for u, ks in by.items()} and max(got.values()) == 4


def test_steps_of_one_type(make_events):
    e = make_events([(i, "u", "a") for i in range(2)] + [(5, "v", "a"), (6, "w", "x")])
    assert rows_of(ordered_steps(e, ["a", "a", "a"], ["user_id"]), "user_id", "reached") == [("u", 2), ("v", 1)]


def daily_rows(spark, rows):
    return spark.createDataFrame([(i, k, v, t) for i, k, v, t in rows], "id long, event_type string, value double, t string").selectExpr(
        "id", "event_type", "value", "cast(t as timestamp_ntz) timestamp")


def test_daily_view_reads_new_days_only(spark, tmp_path):
    rows = [(i, "ab"[i % 2], float(i), f"2024-01-{1 + i // 4:02d} 0{i % 4}:00:00") for i in range(40)]
    e = daily_rows(spark, rows)
    view = warehouse.DailyView(spark, str(tmp_path / "v"), _daily_parts, _daily_merge)
    full = rows_of(_daily_merge(_daily_parts(e.withColumn("day", F.to_date("timestamp")))), "event_type", "n", "least", "most", "newest_id")
    view.refresh(e.where("id < 18"))
    before = {f: os.path.getmtime(tmp_path / "v" / f) for f in os.listdir(tmp_path / "v") if "=" in f}
    view.refresh(e)
    view.refresh(e)
    assert rows_of(view.read(), "event_type", "n", "least", "most", "newest_id") == full
    assert view.stored().groupBy("day", "event_type").count().where("count > 1").count() == 0
    kept = {f: os.path.getmtime(tmp_path / "v" / f) for f in before}
    assert all(kept[f] == before[f] for f in before if f < "day=2024-01-05")
    # a correction of an old day is taken in when that day is named
    corrected = e.withColumn("value", F.when(F.col("id") == 0, -5.0).otherwise(F.col("value")))
    assert view.refresh(corrected).read().agg(F.min("least")).first()[0] == 0.0
    assert view.refresh(corrected, ["2024-01-01"]).read().agg(F.min("least")).first()[0] == -5.0


def test_daily_view_without_rows(spark, tmp_path):
    e = daily_rows(spark, [(1, "a", 1.0, "2024-01-01 00:00:00")])
    view = warehouse.DailyView(spark, str(tmp_path / "v"), _daily_parts, _daily_merge)
    assert view.refresh(e.where("false")).refresh(e).refresh(e.where("false")).read().count() == 1


def test_one_old_version_of_a_view_stays(spark):
    name = f"mv_{uuid.uuid4().hex[:8]}"
    view = warehouse.MaterializedView(spark, name, "SELECT 1 AS n").create()
    first = spark.sql(f"DESCRIBE EXTENDED {view.versions()[0]}").where("col_name = 'Location'").first().data_type
    for _ in range(3):
        view.refresh()
    assert view.versions() == [f"{name}__000000003", f"{name}__000000004"]
    assert not os.path.exists(first.removeprefix("file:")) and view.read().collect()[0].n == 1


def test_days_are_replaced_and_expire_by_their_folders(spark, tmp_path):
    e = daily_rows(spark, [(i, "a", 1.0, f"2024-01-{1 + i:02d} 12:00:00") for i in range(6)] + [(9, "n", 0.0, None)])
    path = str(tmp_path / "p")
    warehouse.write_partitioned(e, path, "timestamp")
    times = {f: os.path.getmtime(tmp_path / "p" / f) for f in os.listdir(path) if "=" in f}
    warehouse.write_partitioned(daily_rows(spark, [(50, "b", 2.0, "2024-01-03 01:00:00")]), path, "timestamp", replace="days")
    got = rows_of(spark.read.parquet(path).where("id != 9"), "id")
    assert got == [(0,), (1,), (3,), (4,), (5,), (50,)]
    assert all(os.path.getmtime(tmp_path / "p" / f) == t for f, t in times.items() if f != "event_date=2024-01-03")
    found = rows_of(warehouse.partition_expiry(spark, path, "2024-01-04 12:00:00", 2), "event_date", "expired")
    assert found == [(date(2024, 1, d), d == 1) for d in range(1, 7)]
    assert warehouse.drop_expired(spark, path, "2024-01-05 00:00:00", 2) == ["2024-01-01", "2024-01-02"]
    assert rows_of(spark.read.parquet(path).where("id != 9"), "id") == [(3,), (4,), (5,), (50,)]
    assert warehouse.partition_expiry(spark, str(tmp_path / "none"), "2024-01-01 00:00:00").count() == 0


def test_snapshots_find_changed_rows(spark, tmp_path):
    def rows(values):
        return spark.createDataFrame(values, "id long, day string, v double").repartition(3)

    first = [(i, f"d{i % 4}", 1.0) for i in range(40)] + [(99, None, 2.0), (7, "d3", 1.0)]
    copies = files.Snapshots(spark, str(tmp_path), F.col("day"), ["id", "day", "v"])
    assert copies.copy(rows(first), 0).count() == 5 and copies.verify(0).count() == 0
    assert copies.changes(rows(first[::-1]), 0).count() == 0  # the order of rows does not matter
    assert rows_of(copies.changes(rows(first + [(7, "d3", 1.0)] * 2), 0), "part", "change") == [("d3", "changed")]
    second = [r for r in first if r[1] != "d1" and r[0] != 2] + [(2, "d2", 1.5), (50, "d9", 1.0)]
    times = {f: os.path.getmtime(tmp_path / "data" / f) for f in os.listdir(tmp_path / "data") if "=" in f}
    got = rows_of(copies.copy(rows(second), 1), "part", "change")
    assert got == [("d1", "gone"), ("d2", "changed"), ("d9", "new")]
    assert all(os.path.getmtime(tmp_path / "data" / f"part={p}") == times[f"part={p}"] for p in ("d0", "d3", "null"))
    assert sorted(map(str, copies.read(1).select("id", "day", "v").collect())) == sorted(map(str, rows(second).collect()))
    assert copies.verify(1).count() == 0
    # a file of the copy that is not what was written
    rows([(1000, "d0", 0.0)]).drop("part").write.mode("append").parquet(str(tmp_path / "data" / "part=d0"))
    assert rows_of(copies.verify(1), "part", "change") == [("d0", "changed")]


def test_headers_through_topic_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "é"), (2, None, None)], "id long, kind string, agent string")
    topics.to_envelope(df, "id", ["kind", "agent"]).write.json(str(tmp_path / "t"))
    back = spark.read.schema(f"key string, value string, headers {topics.HEADERS}").json(str(tmp_path / "t"))
    got = {r.key: r.a for r in back.select("key", topics.attributes().alias("a")).collect()}
    assert got == {"1": {"kind": "a", "agent": "é"}, "2": {}}
    twice = spark.sql("SELECT array(named_struct('key', 'a', 'value', cast('1' AS binary)), "
                      "named_struct('key', 'a', 'value', cast('2' AS binary))) headers UNION ALL SELECT null")
    assert sorted(str(r.a) for r in twice.select(topics.attributes().alias("a")).collect()) == ["{'a': '2'}", "{}"]
    options = topics.kafka_options(Settings(), ["t"], headers=True)
    assert options["includeHeaders"] == "true" and "includeHeaders" not in topics.kafka_options(Settings(), ["t"])


def test_sizes_do_not_depend_on_splits(spark):
    e = model.table(spark, SF, "events")
    a = rows_of(Q.partition_sizes(e, F.to_date("ts")), "partition", "rows", "bytes")
    assert a == rows_of(Q.partition_sizes(e.repartition(7), F.to_date("ts")), "partition", "rows", "bytes")
    odd = spark.createDataFrame([(1, None, True), (None, "é", None)], "a int, b string, c boolean")
    assert [r.n for r in odd.select(Q.row_bytes(odd).alias("n")).collect()] == [5, 2]
    splits = Q.scan_splits(e).collect()
    assert sum(r.rows for r in splits) == 1000 and all(r.file.endswith(".parquet") and r.bytes > 0 for r in splits)
