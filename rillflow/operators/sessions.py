"""Session metrics per event and session tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import attach


def _seconds(later, earlier):
    return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))


def session_table(events: DataFrame) -> DataFrame:
    """One row per session: start, end, whole seconds, events and distinct pages."""
    return events.groupBy("session_id").agg(
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        F.count("*").alias("page_views"),
        F.countDistinct("page_url").alias("unique_pages"),
    ).withColumn("session_duration", _seconds(F.col("session_end"), F.col("session_start")))


def session_metrics(events: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """Events with the metrics of their whole session. `base` may give the same rows before other
    columns were added, so that the aggregate does not compute those again.

    Aggregate and attach instead of windows: the aggregate shrinks before the shuffle, and the
    join splits sessions that hold many rows, which a window cannot.
    """
    return attach(events, session_table(events if base is None else base), ["session_id"], "page_views", ["id"])
