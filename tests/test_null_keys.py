"""Rows without a metric name are a group of their own, as in plain windows."""

from datetime import timedelta

from conftest import T0, rows_of
from rillflow.operators.metrics import newest
from rillflow.operators.running import numbered, with_previous

SCHEMA = "id long, metric_name string, metric_value double, timestamp timestamp_ntz"


def test_null_keys(spark):
    rows = [(i, "m" if i % 3 else None, float(i), T0 + timedelta(seconds=20 * i)) for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = with_previous(df, "metric_name", "timestamp", "id", "metric_value", "p").fillna(-1.0)
    assert [r[1] for r in rows_of(got.where("metric_name is null"), "id", "p")] == [-1.0, 0.0, 3.0, 6.0]
    assert [r[1] for r in rows_of(numbered(df, ["metric_name"], "timestamp", "id", "n").where(
        "metric_name is null"), "id", "n")] == [1, 2, 3, 4]
    assert newest(df, 2).where("metric_name is null").count() == 2
