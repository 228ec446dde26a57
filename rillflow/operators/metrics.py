"""Metric series: summaries, changes, rollups, health and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.numeric import exact_mean, exact_sum, mean_units, units
from ..functions.timefn import MINUTE, cell, micros, since
from .running import same_keys, with_previous

# Alert rule, threshold in parts per million (or plain units) and severity.
ALERT_RULES = [
    ("error_rate", 10_000, "error"),          # more than 1 % of the events
    ("processing_lag_seconds", 300, "warning"),   # more than 5 minutes
    ("utilization", 800_000, "warning"),      # more than 80 %
    ("failed_checks", 0, "error"),            # any failed check
    ("late_rows", 10_000, "warning"),         # more than 1 % dropped by the watermark
]
# Measures given as a share num / den; the others are plain numbers.
SHARES = ["error_rate", "utilization", "late_rows"]


def newest_value() -> Column:
    """The value of the newest row of a group, the larger id on equal times."""
    return F.max(F.struct("timestamp", "id", "metric_value")).getField("metric_value")


def newest(metrics: DataFrame, keep: int = 1000) -> DataFrame:
    """The newest `keep` rows per metric.

    Row counts per minute tell from which minute on a metric has `keep` rows; older rows are
    dropped before anything is ordered, so a metric with very many rows stays cheap.
    """
    at = cell(micros("timestamp"), MINUTE)
    newer = W.partitionBy("metric_name").orderBy(F.col("_cell").desc()).rowsBetween(
        W.unboundedPreceding, -1)
    start = (
        metrics.groupBy("metric_name", at.alias("_cell")).agg(F.count("*").alias("_n"))
        .withColumn("_newer", F.coalesce(F.sum("_n").over(newer), F.lit(0).cast("long")))
        .groupBy("metric_name").agg(
            F.min(F.when(F.col("_newer") < keep, F.col("_cell"))).alias("_from"),
            F.sum("_n").alias("_rows"))
    )
    w = W.partitionBy("metric_name").orderBy(F.col("timestamp").desc(), F.col("id").desc())
    return (
        same_keys(metrics, start.drop("_rows"), ["metric_name"])
        .where(at >= F.col("_from"))
        .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= keep)
        .drop("_rn", "_from")
    )


def metric_summary(metrics: DataFrame, keep: int = 1000, scale: int | None = None) -> DataFrame:
    v = F.col("metric_value")
    return newest(metrics, keep).groupBy("metric_name").agg(
        F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"),
        exact_mean(v, scale).alias("avg"),
        newest_value().alias("latest_value"),
    )


def change_columns(previous: str, threshold: float = 20.0) -> dict[str, Column]:
    p, v = F.col(previous), F.col("metric_value")
    change = (v - p) / F.nullif(p, F.lit(0.0)) * F.lit(100.0)
    return {
        "change_percent": change,
        "is_significant": F.coalesce(F.abs(change) > threshold, F.lit(False)),
    }


def metric_change(metrics: DataFrame, threshold: float = 20.0) -> DataFrame:
    """Percent change against the previous value of the metric; null when that is 0 or absent."""
    return with_previous(
        metrics, "metric_name", "timestamp", "id", "metric_value", "previous_value"
    ).withColumns(change_columns("previous_value", threshold))


def rollup(metrics: DataFrame, period: str = "300 seconds", scale: int | None = None,
           keys: tuple[str, ...] = ("metric_name", "dimensions")) -> DataFrame:
    """Average, sum, maximum and minimum per period, metric and dimensions."""
    v = F.col("metric_value")
    return metrics.groupBy(F.window("timestamp", period).alias("w"), *keys).agg(
        exact_mean(v, scale).alias("average"), exact_sum(v, scale).alias("sum"),
        F.max(v).alias("maximum"), F.min(v).alias("minimum"),
    ).select(F.col("w.start").alias("period_start"), *keys, "average", "sum", "maximum", "minimum")


def align_reduce(metrics: DataFrame, period: str = "300 seconds", scale: int | None = None,
                 labels: dict[str, str] | None = None) -> DataFrame:
    """Mean per series and period, then the mean of these means per metric and period.

    `labels` keeps only series whose dimensions have the given values.
    """
    for name, wanted in (labels or {}).items():
        metrics = metrics.where(F.get_json_object("dimensions", f"$.{name}") == wanted)
    v = F.col("metric_value")
    per_series = metrics.groupBy(
        F.window("timestamp", period).alias("w"), "metric_name", "dimensions")
    if scale is None:
        aligned, mean = per_series.agg(F.avg(v).alias("m")), F.avg("m")
    else:
        aligned = per_series.agg(mean_units(F.sum(units(v, scale)), F.count(v)).alias("m"))
        mean = F.sum("m").cast("double") / F.count("m") / F.lit(10.0 ** (scale + 4))
    return aligned.groupBy("w", "metric_name").agg(
        mean.alias("value"), F.count("*").alias("series")
    ).select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"),
             "metric_name", "value", "series")


def latest_metric(metrics: DataFrame, as_of: str, span: str = "1 hour",
                  scale: int | None = None) -> DataFrame:
    """Newest value of each metric in the span, and the average of its newest 5-minute period."""
    recent = since(metrics, "timestamp", as_of, span)
    raw = recent.groupBy("metric_name").agg(
        newest_value().alias("latest_value"),
        F.max("timestamp").alias("latest_time"))
    period = rollup(recent, scale=scale, keys=("metric_name",)).groupBy("metric_name").agg(
        F.max_by("average", "period_start").alias("latest_average"))
    return raw.join(period, "metric_name")


def health_rollup(status: DataFrame, keys: list[str]) -> DataFrame:
    """Overall state per pipeline and window from one status row per component.

    overall_status: healthy when all are, degraded when more than half are, else unhealthy.
    api_status: healthy when all are, error when any component reports an error, else degraded.
    """
    s = F.col("status")
    out = status.groupBy(*keys).agg(
        F.count("*").alias("components"),
        F.count_if(s == "healthy").alias("healthy_components"),
        F.count_if(s == "error").alias("_errors"),
    )
    n, ok = F.col("components"), F.col("healthy_components")
    return out.withColumns({
        "overall_status": F.when(ok == n, "healthy")
        .when(ok > F.floor(n / 2), "degraded").otherwise("unhealthy"),
        "api_status": F.when(ok == n, "healthy")
        .when(F.col("_errors") > 0, "error").otherwise("degraded"),
    }).drop("_errors")


def alerts(measures: DataFrame, rules: list[tuple[str, int, str]] = ALERT_RULES) -> DataFrame:
    """Measures (window_start, metric, num, den) above their rule's threshold, with severity.

    The rules are a handful of constants, so they are a map expression rather than a join.
    """
    limit = F.create_map(*[F.lit(x) for name, t, _ in rules for x in (name, t)])
    severity = F.create_map(*[F.lit(x) for name, _, s in rules for x in (name, s)])
    unit = F.when(F.col("metric").isin(SHARES), F.lit(1_000_000)).otherwise(F.lit(1)).cast("long")
    return (
        measures.withColumn("threshold", F.element_at(limit, F.col("metric")))
        .where((F.col("den") > 0)
               & (F.col("num") * unit > F.col("threshold").cast("long") * F.col("den")))
        .select("window_start", "metric", "num", "den",
                F.element_at(severity, F.col("metric")).alias("severity"))
    )


def event_measures(events: DataFrame, window: str = "1 hour", error: str = "error") -> DataFrame:
    """Error share and lag per window; lag = seconds from the newest event to the window's end."""
    w = events.groupBy(F.window("timestamp", window).alias("w")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == error).alias("errors"),
        F.max("timestamp").alias("newest"))
    lag = F.unix_seconds(F.col("w.end").cast("timestamp")) - F.unix_seconds(
        F.col("newest").cast("timestamp"))
    one = F.lit(1).cast("long")
    return w.select(
        F.col("w.start").alias("window_start"),
        F.explode(F.array(
            F.struct(F.lit("error_rate").alias("metric"), F.col("errors").alias("num"),
                     F.col("n").alias("den")),
            F.struct(F.lit("processing_lag_seconds").alias("metric"), lag.alias("num"),
                     one.alias("den")),
        )).alias("m")).select("window_start", "m.*")


def health_measures(health: DataFrame, window_start: str) -> DataFrame:
    """Failed checks of a health_rollup as measures for `alerts`."""
    return health.select(
        F.col(window_start).alias("window_start"), F.lit("failed_checks").alias("metric"),
        (F.col("components") - F.col("healthy_components")).alias("num"),
        F.lit(1).cast("long").alias("den"))


def run_measures(commits: DataFrame, capacity: int) -> DataFrame:
    """Measures for `alerts` from the commit records of a stream (see streaming/commits.py), one batch
    each: share of errors and broken rows, lag = processing time - newest event time, and
    utilization = rows of a batch of the `capacity` rows that one batch may have. Nothing is scanned again.
    """
    processed, newest = F.timestamp_micros("processed_at"), F.timestamp_micros("newest")
    lag = F.unix_seconds(processed) - F.unix_seconds(newest)
    one = F.lit(1).cast("long")
    values = [("error_rate", F.col("errors") + F.col("rows_dead_letters"), F.col("rows")),
              ("processing_lag_seconds", lag, one), ("utilization", F.col("rows"), F.lit(capacity).cast("long"))]
    return commits.select("batch", processed.alias("window_start"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("metric"), num.alias("num"), den.alias("den")) for name, num, den in values
    ])).alias("m")).where("m.num IS NOT NULL").select("window_start", "m.*")
