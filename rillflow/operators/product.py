"""Session reconciliation, hourly rates, retention and funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.numeric import div, pct2
from ..functions.timefn import MINUTE, cell, micros, since

# Step label and event type.
FUNNEL = [("Page View", "page_view"), ("Click", "click"), ("Add to Cart", "add_to_cart"),
          ("Purchase", "purchase")]


def session_analysis(sessions: DataFrame, events: DataFrame, as_of: str,
                     page_view: str = "page_view", top: int = 5000) -> DataFrame:
    """Stored session figures next to those counted from the events; the `top` longest sessions.

    Sessions without events drop out (the HAVING of the left join), so the events of the
    recent sessions are aggregated per session first and joined inner: the join sees one row per session on both sides.
    """
    recent = since(sessions, "start_time", as_of, "7 days")
    found = events.join(recent.select("session_id"), "session_id", "left_semi").groupBy("session_id").agg(
        F.count("id").alias("actual_events"),
        F.countDistinct("event_type").alias("event_types"),
        F.countDistinct("page_url").alias("pages_visited"),
        F.count_if(F.col("event_type") == page_view).alias("_pv"),
    ).where("actual_events > 0")
    return (
        recent.select("session_id", "user_id", "duration_seconds", "page_views", "unique_pages",
                "device_type", "country")
        .join(found, "session_id")
        .withColumn("page_view_ratio", F.col("_pv").cast("double") / F.col("actual_events"))
        .drop("_pv")
        .orderBy(F.col("duration_seconds").desc_nulls_first(), "session_id").limit(top)
    )


def hourly_metrics(events: DataFrame, as_of: str, span: str = "24 hours",
                   purchase: str = "purchase", completion: str = "video_complete") -> DataFrame:
    kind = F.col("event_type")
    return (
        since(events, "timestamp", as_of, span)
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour_window"))
        .agg(
            F.count("*").alias("total_events"),
            F.countDistinct("user_id").alias("unique_users"),
            F.countDistinct("session_id").alias("unique_sessions"),
            F.countDistinct("event_type").alias("event_types"),
            F.count_if(kind == purchase).alias("purchases"),
            F.count_if(kind == completion).alias("video_completions"),
        )
        .withColumns({
            "conversion_rate": pct2(F.col("purchases"), F.col("total_events")),
            "video_completion_rate": pct2(F.col("video_completions"), F.col("total_events")),
        })
        .orderBy(F.col("hour_window").desc())
    )


def minute_metrics(events: DataFrame, as_of: str, span: str = "1 hour") -> DataFrame:
    return since(events, "timestamp", as_of, span).groupBy(
        F.date_trunc("minute", "timestamp").alias("minute_window")
    ).agg(F.count("*").alias("events_per_minute"),
          F.countDistinct("user_id").alias("users_per_minute"))


def time_windows(events: DataFrame, as_of: str, span: str = "24 hours") -> DataFrame:
    """The (hour, minute) windows that hold events."""
    return since(events, "timestamp", as_of, span).select(
        F.date_trunc("hour", "timestamp").alias("hour_window"),
        F.date_trunc("minute", "timestamp").alias("minute_window"),
    ).distinct()


def user_weeks(events: DataFrame) -> DataFrame:
    """Distinct sessions per user and week, with the user's first week.

    A user's first week is the smallest of their weeks, so the self-join on the user becomes a
    window over at most one row per week.
    """
    return events.groupBy(
        "user_id", F.date_trunc("week", "timestamp").alias("activity_week")
    ).agg(F.countDistinct("session_id").alias("sessions_in_week")).withColumn(
        "cohort_week", F.min("activity_week").over(W.partitionBy("user_id")))


def cohort_retention(events: DataFrame, max_week: int = 12) -> DataFrame:
    """Share of each weekly cohort that is active n weeks later.

    Everyone is active in their own first week, so the cohort size is the active count of week 0
    and needs no second pass; the last window runs over (cohort, week) counts only.
    """
    weeks = events.groupBy(
        "user_id", F.date_trunc("week", "timestamp").alias("activity_week")).agg(
        F.count("*").alias("n"))
    cohort = W.partitionBy("user_id")
    counts = weeks.withColumn("cohort_week", F.min("activity_week").over(cohort)).groupBy(
        "cohort_week",
        div(F.datediff("activity_week", "cohort_week"), F.lit(7)).alias("week_number"),
    ).agg(F.count("*").alias("active_users"))
    size = F.max(F.when(F.col("week_number") == 0, F.col("active_users"))).over(
        W.partitionBy("cohort_week"))
    return (
        counts.withColumn("cohort_size", size).where(F.col("week_number") <= max_week)
        .withColumn("retention_rate", pct2(F.col("active_users"), F.col("cohort_size")))
        .orderBy(F.col("cohort_week").desc(), "week_number")
    )


def funnel(events: DataFrame, as_of: str, steps: list[tuple[str, str]] = FUNNEL,
           span: str = "30 days") -> DataFrame:
    """Sessions that reach each step and the share of the previous step that did."""
    kind = F.col("event_type")
    names = [f"step_{i}" for i in range(1, len(steps) + 1)]
    reached = since(events, "timestamp", as_of, span).where(
        kind.isin([t for _, t in steps])
    ).groupBy("user_id", "session_id").agg(
        *[F.max(F.when(kind == t, 1)).alias(n) for n, (_, t) in zip(names, steps)])
    totals = reached.agg(F.count("*").alias("step_0"), *[F.count(n).alias(n) for n in names])
    return _funnel_rows(totals, steps)


def _funnel_rows(totals: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(label).alias("step_name"), F.col(f"step_{i}").alias("completions"),
                 pct2(F.col(f"step_{i}"), F.col(f"step_{i - 1}")).alias("conversion_rate"))
        for i, (label, _) in enumerate(steps, 1)])
    return totals.select(F.explode(rows).alias("r")).select("r.*").orderBy(
        F.col("completions").desc(), "step_name")


def ordered_steps(events: DataFrame, types: list[str], keys: list[str], ts: str = "timestamp",
                  event_id: str = "id", size: int = MINUTE) -> DataFrame:
    """(keys, reached): how many steps each group takes in order, each one the earliest after the step before.

    The steps are an automaton: in state s the next event of type s + 1 leads to s + 1. The events of one
    cell of time turn each state into another, and these tables compose, so only the rows of one (key, cell) are
    ordered together and a group of any size is a list of one small table per cell.
    """
    n = len(types)
    step = F.array(*map(F.lit, types))
    cut = events.where(F.col("event_type").isin(types)).withColumn("_cell", cell(micros(ts), size))
    states = F.array(*[F.lit(i) for i in range(n + 1)])
    moves = cut.groupBy(*keys, "_cell").agg(F.aggregate(
        F.sort_array(F.collect_list(F.struct(micros(ts).alias("t"), F.col(event_id).alias("i"), F.col("event_type").alias("k")))),
        states, lambda at, e: F.transform(at, lambda s: F.when(F.get(step, s) == e.k, s + 1).otherwise(s))).alias("_to"))
    return moves.groupBy(*keys).agg(F.aggregate(
        F.sort_array(F.collect_list(F.struct("_cell", "_to"))), F.lit(0),
        lambda s, c: F.get(c.getField("_to"), s)).alias("reached"))


def ordered_funnel(events: DataFrame, as_of: str, steps: list[tuple[str, str]] = FUNNEL, span: str = "30 days",
                   keys: tuple[str, ...] = ("user_id", "session_id")) -> DataFrame:
    """The funnel in which every step must come after the one before it (ties by id)."""
    reached = ordered_steps(since(events, "timestamp", as_of, span), [t for _, t in steps], list(keys))
    totals = reached.agg(F.count("*").alias("step_0"), *[
        F.count_if(F.col("reached") >= i).alias(f"step_{i}") for i in range(1, len(steps) + 1)])
    return _funnel_rows(totals, steps)
