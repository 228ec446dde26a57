"""The rows outside a time range that the operators need to judge the rows inside it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.timefn import MINUTE, SECOND, ago, cell, micros, moment
from ..session import shared_dir

#: Days looked back for a user's earlier rows, round by round; the last round looks at everything.
LOOKS = (1, 8, 64, None)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_sessions(events: DataFrame, inside: DataFrame, start: str, end: str, reach: str | None,
                     ts: str = "timestamp") -> DataFrame:
    """All rows, at any time, of the sessions that have rows `inside` [start, end).

    `reach` bounds how long a session lasts, so that the scan reads [start - reach, end + reach)
    only; without it the whole history is scanned for them. The semi-join comes before any
    aggregate: rows of other sessions are dropped by the scan's side where Spark broadcasts the list or
    turns it into a Bloom filter, by its measured size.
    """
    if reach:
        span = F.expr(f"interval {reach}")
        events = events.where((F.col(ts) >= ago(events, ts, start, reach))
                              & (F.col(ts) < moment(events, ts, end) + span))
    return events.join(inside.select("session_id").distinct(), "session_id", "left_semi")


def burst_halo(events: DataFrame, inside: DataFrame, start: str, span_seconds: int = 60,
               history: int = 10, ts: str = "timestamp", user: str = "user_id",
               event_id: str = "id", looks: tuple = LOOKS) -> DataFrame:
    """The rows (user, ts, id) before `start` that the burst rule needs for the rows `inside`: of each
    user there the `history` newest rows, and what lies `span_seconds` before the oldest of those.

    Users differ in how far back that is, so the search goes back in rounds: a day, then eight times as
    far, and only for users who have not enough rows yet. Per round the rows are counted per (user,
    minute), so no user's rows are ordered or collected; the bound is the start of a minute, which
    takes in a few rows more than needed and changes nothing. The last round reads the
    whole history, for the users who are new or rare, and is left out when there are none.
    """
    events = events.select(user, ts, event_id)
    begin = moment(events, ts, start)
    open_ = _stored(inside.where(F.col(user).isNotNull()).select(user).distinct(), "halo-users")
    parts = []
    for days in looks:
        lower = None if days is None else ago(events, ts, start, f"{days} days")
        past = events.where(F.col(ts) < begin)
        near = past if lower is None else past.where(F.col(ts) >= lower)
        minutes = near.join(open_, user, "left_semi").groupBy(
            user, cell(micros(ts), MINUTE).alias("_cell")).agg(F.count("*").alias("_n"))
        newer = W.partitionBy(user).orderBy(F.desc("_cell"))
        enough = minutes.withColumn("_seen", F.sum("_n").over(newer)).groupBy(user).agg(
            F.max(F.when(F.col("_seen") >= history, F.col("_cell"))).alias("_from"))
        bounds = _stored(enough.where(F.col("_from").isNotNull()) if days else enough, "halo-bounds")
        reach = past if lower is None else past.where(
            F.col(ts) >= lower - F.expr(f"interval {int(span_seconds)} seconds"))
        rows = reach.join(bounds, user).where(
            F.col("_from").isNull() | (micros(ts) >= F.col("_from") - span_seconds * SECOND))
        parts.append(rows.select(user, ts, event_id))
        if days is not None:
            open_ = _stored(open_.join(bounds, user, "left_anti"), "halo-users")
            if not open_.limit(1).count():
                break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
