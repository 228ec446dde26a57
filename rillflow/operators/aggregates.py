"""User, session and time aggregates of the event frame.

Plain groupBy aggregates: Spark combines them before the shuffle, so a hot key sends one row per
task. Distinct counts shuffle on (key, value) first. `scale` is explained in functions/numeric.py.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.numeric import (
    div, exact_mean, exact_std, exact_sum, mean_units, pct2, spread, sum_squares, units,
)
from ..functions.timefn import ago, since
from .skew import attach


def user_metrics(events: DataFrame, scale: int | None = None) -> DataFrame:
    v = F.col("value")
    return events.groupBy("user_id").agg(
        exact_sum(v, scale).alias("value_sum"),
        exact_mean(v, scale).alias("value_mean"),
        exact_std(v, scale).alias("value_std"),
        F.count(v).alias("value_count"),
        F.countDistinct("event_type").alias("event_type_nunique"),
        F.countDistinct("session_id").alias("session_id_nunique"),
        F.min("timestamp").alias("timestamp_min"),
        F.max("timestamp").alias("timestamp_max"),
    )


def most_common(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The most frequent non-null value per key, the smallest one on ties.

    Counts per (key, value) come first, so no task holds the value table of a key.
    """
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return n.groupBy(*keys).agg(best.getField("v").alias(name))


def session_analytics(events: DataFrame, scale: int | None = None) -> DataFrame:
    """First user, device and country, times, values, distinct types and the usual category."""
    first = F.min(F.struct("timestamp", "id", "user_id", "device_type", "country"))
    v = F.col("value")
    base = events.groupBy("session_id").agg(
        *[first.getField(c).alias(f"{c}_first") for c in ("user_id", "device_type", "country")],
        F.min("timestamp").alias("timestamp_min"),
        F.max("timestamp").alias("timestamp_max"),
        F.count("timestamp").alias("events_per_session"),
        exact_sum(v, scale).alias("total_value"),
        exact_mean(v, scale).alias("avg_value"),
        F.countDistinct("event_type").alias("unique_event_types"),
    )
    usual = most_common(events, ["session_id"], "category", "category_mode")
    length = F.unix_micros(F.col("timestamp_max").cast("timestamp")) - F.unix_micros(
        F.col("timestamp_min").cast("timestamp"))
    return base.join(usual, "session_id", "left").withColumns({
        "category_mode": F.coalesce("category_mode", F.lit("Unknown")),
        "session_duration_minutes": length / F.lit(60_000_000.0),
    })


def _with_empty_hours(per_hour: DataFrame) -> DataFrame:
    """Adds the hours that are missing between two rows, with null values.

    Each row produces the hours up to the next one; the window has one row per hour.
    """
    hour = F.expr("interval 1 hour")
    until = F.coalesce(F.lead("hour").over(W.partitionBy().orderBy("hour")) - hour, F.col("hour"))
    values = [c for c in per_hour.columns if c != "hour"]
    return per_hour.withColumn("_until", until).withColumn(
        "_at", F.explode(F.sequence("hour", "_until", hour))
    ).select(F.col("_at").alias("hour"),
             *[F.when(F.col("_at") == F.col("hour"), F.col(c)).alias(c) for c in values])


def hourly_resample(events: DataFrame, scale: int | None = None) -> DataFrame:
    """One row per hour, empty hours included (count 0, sum 0, mean null, type 'None').

    Sums and the usual type come from counts per (hour, type); ties go to the smaller type.
    """
    e = events.withColumn("hour", F.date_trunc("hour", "timestamp"))
    v, kind = F.col("value"), F.col("event_type")
    unit = v if scale is None else units(v, scale)
    usual = F.min(F.when(kind.isNotNull(), F.struct((-F.col("_n")).alias("n"), kind.alias("t"))))
    size = F.lit(1.0 if scale is None else float(10 ** scale))
    total, count = F.sum("_s").cast("double"), F.sum("_c")
    per_hour = e.groupBy("hour", "event_type").agg(
        F.sum(unit).alias("_s"), F.count(v).alias("_c"), F.count("*").alias("_n"),
    ).groupBy("hour").agg(
        (total / size).alias("value_sum"),
        (total / F.nullif(count, F.expr("0L")) / size).alias("value_mean"),
        count.alias("value_count"),
        usual.getField("t").alias("event_type_mode"),
    )
    who = e.groupBy("hour").agg(
        F.countDistinct("user_id").alias("user_id_nunique"),
        F.countDistinct("session_id").alias("session_id_nunique"),
    )
    return _with_empty_hours(per_hour.join(who, "hour")).fillna({
        "value_sum": 0.0, "value_count": 0, "user_id_nunique": 0, "session_id_nunique": 0,
        "event_type_mode": "None"})


def rolling_24h(events: DataFrame, scale: int | None = None, hours: int = 24) -> DataFrame:
    """hourly_resample with rolling means over `hours` rows. Its input is one row per hour."""
    hourly = hourly_resample(events, scale)
    w = W.partitionBy().orderBy("hour").rowsBetween(1 - hours, 0)
    total = F.col("value_sum")
    mean = F.avg(total).over(w) if scale is None else (
        F.sum(units(total, scale)).over(w).cast("double")
        / F.count(total).over(w) / F.lit(float(10 ** scale)))
    return hourly.withColumns({
        "value_sum_rolling_24h": mean,
        "user_id_nunique_rolling_24h":
            F.sum("user_id_nunique").over(w).cast("double") / F.count("hour").over(w),
    })


def resample_sum(events: DataFrame, scale: int | None = None) -> DataFrame:
    per_hour = events.groupBy(F.date_trunc("hour", "timestamp").alias("hour")).agg(
        exact_sum(F.col("value"), scale).alias("value_sum"))
    return _with_empty_hours(per_hour).fillna({"value_sum": 0.0})


def sum_by_user(events: DataFrame, scale: int | None = None) -> DataFrame:
    return events.groupBy("user_id").agg(exact_sum(F.col("value"), scale).alias("value_sum"))


def mean_by_session(events: DataFrame, scale: int | None = None) -> DataFrame:
    return events.groupBy("session_id").agg(exact_mean(F.col("value"), scale).alias("value_mean"))


def daily_activity(events: DataFrame, as_of: str, span: str = "30 days") -> DataFrame:
    return since(events, "timestamp", as_of, span).groupBy(
        "user_id", F.to_date("timestamp").alias("activity_date")
    ).agg(
        F.count("*").alias("daily_events"),
        F.countDistinct("session_id").alias("daily_sessions"),
        F.countDistinct("event_type").alias("event_types_used"),
        F.min("timestamp").alias("first_event"),
        F.max("timestamp").alias("last_event"),
    )


def activity_level(days: Column) -> Column:
    return (
        F.when(days >= 20, "Highly Active").when(days >= 10, "Moderately Active")
        .when(days >= 5, "Occasionally Active").otherwise("Rarely Active")
    )


def user_activity(events: DataFrame, as_of: str, top: int = 1000) -> DataFrame:
    """30-day rollup of daily activity; the `top` users by number of events."""
    days = F.count("*")
    return (
        daily_activity(events, as_of).groupBy("user_id").agg(
            (F.sum("daily_events").cast("double") / days).alias("avg_daily_events"),
            (F.sum("daily_sessions").cast("double") / days).alias("avg_daily_sessions"),
            F.sum("daily_events").alias("total_events_30d"),
            days.alias("active_days"),
            F.max("daily_events").alias("peak_daily_events"),
        )
        .withColumn("activity_level", activity_level(F.col("active_days")))
        .orderBy(F.col("total_events_30d").desc(), "user_id").limit(top)
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first."""
    n = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)
    return n if top is None else n.limit(top)


def hour_of_day(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("timestamp").alias("hour")).agg(F.count("*").alias("n"))


def event_statistics(events: DataFrame) -> DataFrame:
    """Totals over all events. Counting per (user, session) first replaces two global distincts."""
    return (
        events.groupBy("user_id", "session_id").agg(F.count("*").alias("n"))
        .groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_events_processed"),
            F.count("*").alias("unique_users"),
            F.coalesce(F.sum("sessions"), F.lit(0).cast("long")).alias("total_sessions"),
        )
        .withColumn("average_events_per_user", F.coalesce(
            F.col("total_events_processed").cast("double")
            / F.nullif(F.col("unique_users"), F.lit(0).cast("long")), F.lit(0.0)))
    )


def kpis(events: DataFrame, as_of: str, scale: int | None = None) -> DataFrame:
    v = F.col("value")
    recent = F.col("timestamp") >= ago(events, "timestamp", as_of, "24 hours")
    return events.agg(
        F.count("*").alias("total_events"),
        F.countDistinct("user_id").alias("unique_users"),
        F.countDistinct("session_id").alias("unique_sessions"),
        F.count_if(recent).alias("events_last_24h"),
        exact_mean(v, scale).alias("avg_value"),
    )


def user_zscore(events: DataFrame, scale: int | None = None, threshold: float = 3.0,
                dispersion: str = "std_of_mean", only_anomalies: bool = False) -> DataFrame:
    """Per-user mean, std and count with the z-score of the mean among all users' means.

    `dispersion="std_of_std"` divides by the spread of the users' standard deviations instead.
    With `scale`, means enter the global statistics rounded to scale + 4 decimals, so that these
    are exact sums too. The global statistics are one-row scalar subqueries.
    """
    v = F.col("value")
    per_user = events.where(v.isNotNull()).groupBy("user_id")
    cols = [exact_mean(v, scale).alias("mean"), exact_std(v, scale).alias("std"),
            F.count(v).alias("count")]
    if scale is None:
        stats = per_user.agg(*cols)
        center = stats.agg(F.avg("mean")).scalar()
        width = stats.agg(F.stddev_samp("mean" if dispersion == "std_of_mean" else "std")).scalar()
        z = (F.col("mean") - center) / F.nullif(width, F.lit(0.0))
    else:
        stats = per_user.agg(*cols, mean_units(F.sum(units(v, scale)), F.count(v)).alias("_m"))
        m = F.col("_m")
        of_means = stats.agg(F.struct(
            F.count(m).alias("n"), F.sum(m).alias("s"),
            spread(F.count(m), F.sum(m), sum_squares(m)).alias("w")).alias("g")).scalar()
        n, s, w = (of_means.getField(f) for f in ("n", "s", "w"))
        if dispersion == "std_of_std":
            w = stats.agg(F.stddev_samp("std")).scalar() * F.lit(10.0 ** (scale + 4))
        gap = n.cast("decimal(19,0)") * m.cast("decimal(19,0)") - s.cast("decimal(38,0)")
        z = gap.cast("double") / F.nullif(n.cast("double") * w, F.lit(0.0))
    out = stats.withColumn("z_score", z).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > threshold, F.lit(False)))
    if scale is not None:
        out = out.drop("_m")
    return out.where("is_anomaly") if only_anomalies else out


def user_dim(events: DataFrame) -> DataFrame:
    """Distinct (user, country) pairs: more than one row for a user seen in two countries."""
    return events.select("user_id", "country").dropDuplicates()


def latest_country(events: DataFrame) -> DataFrame:
    """One row per user: the country of the newest event, and the user's number of events."""
    return events.groupBy("user_id").agg(
        F.max(F.struct("timestamp", "id", "country")).getField("country").alias("user_country"),
        F.count("*").alias("user_events"),
    )


def with_user_dim(events: DataFrame) -> DataFrame:
    """Events with their user's country; the join splits users that hold many rows."""
    return attach(events, latest_country(events), ["user_id"], "user_events", ["id"])


def event_share(events: DataFrame) -> DataFrame:
    n = value_counts(events, "event_type")
    total = n.agg(F.sum("n")).scalar()
    return n.withColumn("share_pct", pct2(F.col("n"), total))


def events_timeline(events: DataFrame) -> DataFrame:
    return events.groupBy(F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count("*").alias("events"))


def live_kpis(events: DataFrame, window: str = "1 hour", purchase: str = "purchase",
              error: str = "error") -> DataFrame:
    """Event rate, active sessions, conversion and error percentage per window."""
    kind = F.col("event_type")
    w = events.groupBy(F.window("timestamp", window).alias("w")).agg(
        F.count("*").alias("events"),
        F.countDistinct("session_id").alias("active_sessions"),
        F.count_if(kind == purchase).alias("_p"), F.count_if(kind == error).alias("_e"),
    )
    seconds = F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(
        F.col("w.start").cast("timestamp"))
    return w.select(
        F.col("w.start").alias("window_start"),
        "events",
        (F.col("events").cast("double") / seconds).alias("events_per_second"),
        "active_sessions",
        pct2(F.col("_p"), F.col("events")).alias("conversion_rate"),
        pct2(F.col("_e"), F.col("events")).alias("error_rate"),
    )


def engagement_histogram(events: DataFrame, bins: int = 20) -> DataFrame:
    """Users per equal-width bin of events per user."""
    n = events.groupBy("user_id").agg(F.count("*").alias("n"))
    lo, hi = n.agg(F.min("n")).scalar(), n.agg(F.max("n")).scalar()
    place = div((F.col("n") - lo) * bins, F.nullif(hi - lo, F.lit(0).cast("long")))
    place = F.when(hi > lo, F.least(place, F.lit(bins - 1).cast("long"))).otherwise(0)
    return n.groupBy(place.alias("bin")).agg(
        F.count("*").alias("users"), F.min("n").alias("min_events"), F.max("n").alias("max_events"))


def users_by_country(events: DataFrame) -> DataFrame:
    return events.groupBy("country").agg(F.countDistinct("user_id").alias("users"))


def ranked_users(events: DataFrame) -> DataFrame:
    """Users ranked by number of events, with the next lower number.

    Ranking all users in one ordered window would be one task. Ranks depend only on the number of
    events, and n events have less than sqrt(2n) different numbers per user, so the window runs
    over these and the result is attached to the users.
    """
    n = events.groupBy("user_id").agg(F.count("*").alias("events"))
    levels = n.groupBy("events").agg(F.count("*").alias("_users"))
    down = W.orderBy(F.col("events").desc())
    placed = levels.withColumns({
        "rank": F.coalesce(F.sum("_users").over(
            down.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")) + 1,
        "dense_rank": F.row_number().over(down),
        "next_lower": F.lead("events").over(down),
    })
    return attach(n, placed, ["events"], "_users", ["user_id"]).drop("_users")
