"""Complete jobs: processed events and the batch report."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import Settings
from ..functions.timefn import ago, between, moment
from ..operators import aggregates as A
from ..operators.enrich import enrich_events, essential_columns, time_features
from ..operators.halo import burst_halo, touched_sessions
from ..operators.sessions import session_metrics, session_table
from ..operators.skew import attach
from ..operators.trailing import HORIZONS, bursts, trailing_activity
from ..operators.transforms import shared_input
from ..sources.files import write_all, write_bucket, write_files
from ..sources.warehouse import write_database


def processed_events(events: DataFrame) -> DataFrame:
    """Enrichment, session metrics, trailing activity and burst flags on every event."""
    rows = trailing_activity(session_metrics(enrich_events(events), base=events), base=events)
    return bursts(rows, base=events)


def processed_between(events: DataFrame, start: str, end: str, session_reach: str | None = None) -> DataFrame:
    """The rows of `processed_events` with start <= timestamp < end, from these and their halo alone.

    Trailing activity reads its longest horizon further back, session metrics the other rows of the touched
    sessions (all history, or `session_reach` around the range when no session lasts longer), bursts the last
    rows of the touched users. What is shuffled depends on the range, not on the history.
    """
    longest = max(HORIZONS.values())
    recent = events.where((F.col("timestamp") >= ago(events, "timestamp", start, f"{longest} seconds"))
                          & (F.col("timestamp") < moment(events, "timestamp", end)))
    inside = between(events, "timestamp", start, end)
    rows = trailing_activity(enrich_events(recent), base=recent).where(
        F.col("timestamp") >= moment(events, "timestamp", start))
    sessions = session_table(touched_sessions(events, inside, start, end, session_reach))
    rows = attach(rows, sessions, ["session_id"], "page_views", ["id"])
    halo = burst_halo(events, inside, start).withColumn("_kept", F.lit(False))
    marked = rows.withColumn("_kept", F.lit(True)).unionByName(halo, allowMissingColumns=True)
    slim = inside.select("user_id", "timestamp", "id").unionByName(halo.drop("_kept"))
    return bursts(marked, base=slim).where("_kept").drop("_kept")


def run_events(spark: SparkSession, source: str, target: str, as_of: str | None = None,
               only_essential: bool = False, session_reach: str | None = None) -> None:
    """Events from Parquet, processed, written as Parquet; with `as_of` only the hour before it."""
    events = spark.read.parquet(source)
    if as_of:
        start = str(datetime.fromisoformat(as_of) - timedelta(hours=1))
        out = processed_between(events, start, as_of, session_reach)
    else:
        out = processed_events(events)
    write_files(essential_columns(out) if only_essential else out, target)


def deliver(df: DataFrame, settings: Settings, table: str, path: str) -> None:
    """The processed events to the database and to the configured buckets; computed once."""
    with shared_input(df) as rows:
        write_database(rows, settings, table)
        write_bucket(rows, path, settings, "s3")
        write_bucket(rows, path, settings, "gcs")


def batch_report(events: DataFrame, as_of: str, scale: int | None = None) -> dict[str, DataFrame]:
    """The named results of the batch run; each is lazy."""
    return {
        "user_metrics": A.user_metrics(time_features(events), scale),
        "session_metrics": A.session_analytics(events, scale),
        "time_series": A.rolling_24h(events, scale),
        "anomalies": A.user_zscore(events, scale, only_anomalies=True),
        "kpis": A.kpis(events, as_of, scale),
        "top_event_types": A.value_counts(events, "event_type", 5),
        "device_distribution": A.value_counts(events, "device_type"),
        "country_distribution": A.value_counts(events, "country", 10),
        "hourly_activity": A.hour_of_day(events),
    }


def run_report(events: DataFrame, folder: str, as_of: str, scale: int | None = None) -> None:
    """Writes the batch report: Parquet per frame, JSON for the KPI row."""
    write_all(batch_report(events, as_of, scale), folder, as_json=("kpis",))
