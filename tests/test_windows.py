"""Windows over time cells against the plain definition, including ties, edges and hot keys."""

import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window as W, functions as F

from conftest import T0, rows_of
from rillflow.operators import aggregates as A, metrics as M
from rillflow.operators.running import numbered, with_previous
from rillflow.operators.sessions import session_metrics, session_table
from rillflow.operators.skew import attach
from rillflow.operators.trailing import bursts, trailing_activity

EDGES = [(0, "a"), (0, "a"), (0, "b"), (59.999999, "b"), (60, "a"), (300, "c"), (300.000001, "c"),
         (359.5, "a"), (360, "b"), (3600, "a"), (3600.000001, "d"), (3660, "a"), (7200, "a"),
         (7200.000001, "a"), (86399.999999, "e"), (86400, "e"), (90000, "e"), (-5, "a"), (-300, "f")]


def naive_trailing(rows, seconds):
    us = [round(r[0] * 1e6) for r in rows]
    out = {}
    for i, t in enumerate(us):
        seen = [j for j, x in enumerate(us) if t - seconds * 1_000_000 <= x <= t]
        out[i] = (len(seen), len({rows[j][1] for j in seen}))
    return out


def check_trailing(make_events, rows, horizons):
    got = {r.id: r for r in trailing_activity(make_events(rows), horizons).collect()}
    assert len(got) == len(rows)
    for h, s in horizons.items():
        for i, (n, u) in naive_trailing(rows, s).items():
            assert (got[i][f"events_{h}"], got[i][f"unique_users_{h}"]) == (n, u), (h, rows[i])


def test_trailing_edges(make_events):
    check_trailing(make_events, EDGES, {"5min": 300, "1hour": 3600})


def test_trailing_hot_user_and_hot_time(make_events):
    rnd = random.Random(3)
    rows = [(rnd.uniform(0, 9000), "bot") for _ in range(60)]
    rows += [(1234.5, f"u{i}") for i in range(60)]
    rows += [(rnd.uniform(0, 9000), f"u{rnd.randint(0, 9)}") for _ in range(60)]
    check_trailing(make_events, rows, {"5min": 300, "1hour": 3600})


def test_trailing_odd_horizons(make_events):
    rnd = random.Random(4)
    rows = [(rnd.uniform(0, 400), f"u{rnd.randint(0, 3)}") for _ in range(80)]
    check_trailing(make_events, rows, {"a": 7, "b": 90, "c": 100})


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 7300), st.sampled_from("abc")), min_size=1, max_size=40))
def test_trailing_property(make_events, rows):
    check_trailing(make_events, rows, {"5min": 300, "1hour": 3600})


def test_trailing_null_user_counts_as_event_only(make_events):
    e = make_events([(0, None), (1, "a")])
    assert rows_of(trailing_activity(e), "id", "events_5min", "unique_users_5min") == [
        (0, 1, 0), (1, 2, 1)]


def naive_bursts(rows, span, factor, history):
    us = [round(r[0] * 1e6) for r in rows]
    current = {i: sum(1 for j, x in enumerate(us) if rows[j][1] == rows[i][1]
                      and us[i] - span * 1_000_000 <= x <= us[i]) for i in range(len(rows))}
    out = {}
    for i in range(len(rows)):
        mine = sorted((us[j], j) for j in range(len(rows)) if rows[j][1] == rows[i][1])
        prev = [current[j] for _, j in mine[:mine.index((us[i], i))][-history:]]
        out[i] = (current[i], sum(prev) / len(prev) if prev else None,
                  bool(prev) and current[i] * len(prev) > factor * sum(prev))
    return out


@pytest.mark.parametrize("span,factor", [(60, 3), (10, 2), (3600, 2), (90, 1)])
def test_bursts(make_events, span, factor):
    rnd = random.Random(span)
    rows = [(rnd.uniform(0, 20000), rnd.choice("ab")) for _ in range(60)]
    rows += [(5000 + i / 7, "bot") for i in range(80)] + [(6000.25, "bot")] * 15 + EDGES
    got = {r.id: (r.current_events, r.avg_events, r.is_anomaly)
           for r in bursts(make_events(rows), span, factor).collect()}
    assert got == naive_bursts(rows, span, factor, 10)


def test_default_burst_is_flagged(make_events):
    quiet = [(i * 600, "a") for i in range(11)]
    dense = [(7000 + i * 0.1, "a") for i in range(10)]
    flags = rows_of(bursts(make_events(quiet + dense)), "id", "is_anomaly")
    assert not any(f for i, f in flags if i < 11) and any(f for i, f in flags if i >= 11)


def test_rows_without_user_are_kept(make_events):
    e = make_events([(0, None), (1, None), (1, "a")])
    assert rows_of(bursts(e), "id", "is_anomaly") == [(0, False), (1, False), (2, False)]
    got = {r.id: r.n for r in numbered(e, ["user_id"], "timestamp", "id", "n").collect()}
    assert got == {0: 1, 1: 2, 2: 1}  # rows without a user are a group of their own


def test_numbered_and_previous_equal_plain_windows(make_events):
    rnd = random.Random(5)
    e = make_events([(rnd.choice([rnd.uniform(0, 600), 60, 61]), "hot" if rnd.random() < .5 else "b",
                      None, rnd.randint(0, 3) * 1.0) for _ in range(120)])
    w = W.partitionBy("user_id").orderBy("timestamp", "id")
    plain = e.withColumns({"n": F.row_number().over(w), "p": F.lag("value").over(w)})
    got = with_previous(numbered(e, ["user_id"], "timestamp", "id", "n"),
                        "user_id", "timestamp", "id", "value", "p")
    assert rows_of(got.fillna(-1.0), "id", "n", "p") == rows_of(plain.fillna(-1.0), "id", "n", "p")


def test_attach_splits_hot_keys_and_keeps_every_row(make_events):
    e = make_events([(i, "bot" if i % 3 else f"u{i}") for i in range(300)])
    per_user = A.latest_country(e.withColumn("country", F.lit("X")))
    got = attach(e, per_user, ["user_id"], "user_events", ["id"], floor=10)
    few = attach(e, per_user, ["user_id"], "user_events", ["id"], floor=1, listed=1)
    plain = e.join(per_user, "user_id", "left")
    assert rows_of(got, "id", "user_events") == rows_of(plain, "id", "user_events")
    assert rows_of(few, "id", "user_events") == rows_of(plain, "id", "user_events")
    assert set(got.columns) == set(plain.columns)


def test_attach_leaves_small_keys_alone_and_null_keys_unmatched(make_events):
    e = make_events([(0, None), (1, "a")])
    per_user = e.where("user_id is not null").groupBy("user_id").agg(F.count("*").alias("n"))
    assert [r.n for r in attach(e, per_user, ["user_id"], "n", ["id"]).orderBy("id").collect()] == [
        None, 1]


def test_session_metrics_final_frame(make_events):
    e = make_events([(0, "a"), (10.5, "a"), (10.5, "a"), (70, "b")])
    got = rows_of(session_metrics(e), "id", "session_duration", "page_views", "unique_pages")
    assert got == [(0, 10, 3, 3), (1, 10, 3, 3), (2, 10, 3, 3), (3, 0, 1, 1)]
    ends = {r.session_id: r.session_end for r in session_table(e).collect()}
    assert ends["sa"] == T0 + timedelta(seconds=10.5)


def test_metric_change_zero_previous(spark):
    m = spark.createDataFrame(
        [(i, "m", v, T0 + timedelta(seconds=i * 45)) for i, v in enumerate([0.0, 5.0, 5.5, 7.0])],
        "id long, metric_name string, metric_value double, timestamp timestamp_ntz")
    got = rows_of(M.metric_change(m).fillna(-1.0), "id", "previous_value", "is_significant")
    assert got == [(0, -1.0, False), (1, 0.0, False), (2, 5.0, False), (3, 5.5, True)]


def test_newest_keeps_exactly_the_newest(spark):
    rnd = random.Random(9)
    rows = [(i, "hot" if i % 3 else f"m{i % 5}", float(i), T0 + timedelta(seconds=rnd.randint(0, 400)))
            for i in range(400)]
    m = spark.createDataFrame(
        rows, "id long, metric_name string, metric_value double, timestamp timestamp_ntz")
    w = W.partitionBy("metric_name").orderBy(F.col("timestamp").desc(), F.col("id").desc())
    plain = m.withColumn("rn", F.row_number().over(w)).where("rn <= 25")
    assert rows_of(M.newest(m, 25), "id") == rows_of(plain, "id")
