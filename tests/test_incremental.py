"""The batch job cut to a range equals the full job, and reads only what the range needs."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF, T0
from rillflow.operators.halo import burst_halo
from rillflow.operators.trailing import bursts
from rillflow.plans.jobs import processed_between, processed_events, run_events
from rillflow.plans.registry import PROCESSED
from rillflow.sources import model


def table(df):
    return sorted(map(tuple, df.select(*PROCESSED).collect()), key=str)


def cut(df, start, end):
    return df.where((F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))


def long_history(seed=4):
    """Months of rows: steady users, a hot one, new ones, rows without user or session."""
    rnd, hour = random.Random(seed), 120 * 86400
    rows = [(rnd.uniform(0, hour + 9000), rnd.choice("abc"), None, 1.0, f"s{rnd.randint(0, 40)}") for _ in range(300)]
    rows += [(hour - 40 * 86400 + i * 3600, "slow", None, 1.0, "long") for i in range(3)]
    rows += [(hour - 3000 + i * 20.5, "hot", None, 1.0, "h") for i in range(330)]
    rows += [(hour + 100 + i, "new", None, 1.0, "n") for i in range(4)] + [(hour + 5, None, None, 1.0, None)] * 3
    rows += [(hour + i * 250, u, None, 1.0, f"s{i % 5}") for i in range(14) for u in ("a", "slow", "once")]
    rows += [(hour - 0.5, "slow", None, 1.0, "long"), (hour, "slow", None, 1.0, "long"), (hour + 3600, "slow", None, 1.0, "long")]
    rows += [(hour + 2100 + i * 0.1, "slow", None, 1.0, "long") for i in range(12)]
    return rows, str(T0 + timedelta(seconds=hour)), str(T0 + timedelta(seconds=hour + 3600))


def test_an_hour_equals_the_full_job_cut_to_it(make_events):
    rows, start, end = long_history()
    e = make_events(rows)
    e = e.withColumn("session_id", F.when(F.col("session_id") != "sNone", F.col("session_id")))
    got = table(processed_between(e, start, end))
    assert got == table(cut(processed_events(e), start, end)) and len(got) > 200
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_an_hour_without_rows_and_one_without_history(make_events):
    rows, start, end = long_history()
    e = make_events(rows)
    assert table(processed_between(e, "2023-01-01 00:00:00", "2023-01-01 01:00:00")) == []
    first = make_events([(i, "a") for i in range(5)])
    assert table(processed_between(first, str(T0), "2024-01-01 01:00:00")) == table(processed_events(first))


@pytest.mark.parametrize("history", [1, 3, 10])
def test_halo_gives_the_same_bursts(make_events, history):
    rows, start, end = long_history(history)
    e = make_events(rows)
    inside = cut(e, start, end)
    halo = burst_halo(e, inside, start, 300, history)
    both = inside.unionByName(halo, allowMissingColumns=True)
    cols = ["id", "current_events", "avg_events", "is_anomaly"]
    got = sorted(map(tuple, cut(bursts(both, 300, 2, history), start, end).select(*cols).collect()))
    want = sorted(map(tuple, cut(bursts(e, 300, 2, history), start, end).select(*cols).collect()))
    assert got == want
    # far fewer rows than the history of the touched users
    assert halo.count() < 150


def test_scans_have_a_time_filter(spark):
    e = model.user_events(spark, SF, pages=True)
    p = processed_between(e, "2024-01-30 23:00:00", "2024-01-31 00:00:00", "1 day")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in p.split("\n") if "FileScan" in line and "events.parquet" in line]
    assert scans and all("GreaterThanOrEqual(ts," in line or "LessThan(ts," in line for line in scans)


def test_run_events(spark, tmp_path, make_events):
    rows, _, end = long_history(9)
    make_events(rows).write.parquet(str(tmp_path / "in"))
    run_events(spark, str(tmp_path / "in"), str(tmp_path / "all"))
    run_events(spark, str(tmp_path / "in"), str(tmp_path / "hour"), as_of=end)
    full, hour = (spark.read.parquet(str(tmp_path / x)) for x in ("all", "hour"))
    start = str(T0 + timedelta(days=120))
    assert table(hour) == table(cut(full, start, end)) and hour.count() > 100
