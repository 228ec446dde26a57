"""Every query by name: a function of (session, table folder). All read their whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from ..config import Settings
from ..functions.timefn import between, zoneless
from ..operators import aggregates as A, enrich as E, metrics as M, product as P, quality as Q
from ..operators import running as R, sessions as S, trailing as TR
from ..operators.transforms import apply_all
from ..session import shared_dir, use_utc
from ..sources import files, model, topics, warehouse
from ..sources.model import AS_OF, EVENT_TYPES, FUNNEL_STEPS
from ..streaming import io, jobs
from . import jobs as batch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CENTS = 2  # decimals of events.value


def query(name: str):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return zoneless(fn(use_utc(spark), folder.rstrip("/")))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        return fn

    return add


def _events(spark, folder, **kw) -> DataFrame:
    return model.user_events(spark, folder, **kw)


def _enriched(spark, folder) -> DataFrame:
    return E.enrich_events(_events(spark, folder, pages=True))


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _simple(name: str, fn: Callable[[DataFrame], DataFrame], **kw) -> None:
    query(name)(lambda spark, folder: fn(_events(spark, folder, **kw)))


# ---- rows -------------------------------------------------------------------------------------

@query("clean_url")
def _(spark, folder):
    return model.table(spark, folder, "pages").select(
        "page_id", "url", E.clean_url(F.col("url")).alias("clean_page_url"))


query("enrich_events")(lambda s, f: _enriched(s, f).select(
    "id", "user_agent", "clean_page_url", "device_type", "browser"))
query("essential_cols")(lambda s, f: E.essential_columns(_enriched(s, f)))
_simple("time_features", lambda e: E.time_features(e).select(
    "id", "hour", "day_of_week", "is_weekend", "value_category"))


@query("value_band_udf")
def _(spark, folder):
    return _events(spark, folder).select("id", F.call_function(
        E.register_value_band(spark), F.col("value")).alias("value_category"))


_simple("high_value", lambda e: E.high_value(e).select("id", "user_id", "value"))
_simple("important_events", lambda e: E.important_events(e).select(
    "id", "user_id", "event_type", "timestamp"))
_simple("recent_events", lambda e: E.recent_events(e, 100, 50).select(
    "id", "user_id", "session_id", "event_type", "timestamp"))
_simple("payload_purchase", lambda e: E.purchase_payload(model.with_payloads(e)).select(
    "id", "total_amount", "items_count"))
_simple("payload_typed", lambda e: E.typed_payload(model.with_payloads(e), "view", "click").select(
    "id", "event_type", "video_id", "video_duration", "search_query", "search_results_count"))


@query("parse_json")
def _(spark, folder):
    rows = model.table(spark, folder, "events").select(
        "event_id", F.from_json("props", StructType().add("k", LongType())).alias("p"))
    return rows.select("event_id", "p.k")


@query("metric_dimensions")
def _(spark, folder):
    rows = E.metric_dimensions(model.analytics_metrics(spark, folder))
    return rows.select("id", "metric_name", F.explode("dims").alias("dimension", "label"))


@query("sql_params")
def _(spark, folder):
    return warehouse.run_sql(
        spark,
        "SELECT user_id, count(*) AS n FROM {user_events} "
        "WHERE event_type = :kind AND value >= :least GROUP BY user_id",
        {"kind": "purchase", "least": 10.0}, {"user_events": _events(spark, folder)})


# The wire format of the records below. Its numbers are narrower than the stored ones, so rows with a user
# above 127 or a value above 327.67 are broken messages.
_WIRE = (StructType().add("user_id", "byte").add("event_type", "string").add("cents", "short").add("k", "long"))


def _messages(spark, folder) -> DataFrame:
    """Events as topic records; signups are on a topic that nobody handles."""
    e = model.table(spark, folder, "events")
    value = F.to_json(F.struct(
        "user_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.get_json_object("props", "$.k").cast("long").alias("k")))
    return e.select(
        F.col("user_id").cast("string").alias("key"), value.alias("value"),
        F.when(F.col("event_type") == "signup", "signups").otherwise("user_events").alias("topic"),
        F.col("event_id").alias("offset"))


@query("dead_letter")
def _(spark, folder):
    checked = topics.check_messages(_messages(spark, folder), _WIRE, ["user_events"])
    return topics.dead_letters(checked).select("offset", "key", "value", "topic", "reason")


@query("good_messages")
def _(spark, folder):
    checked = topics.check_messages(_messages(spark, folder), _WIRE, ["user_events"])
    return topics.good_messages(checked).groupBy("k").agg(
        F.count("*").alias("n"), F.sum("cents").alias("cents"))


@query("to_envelope")
def _(spark, folder):
    rows = _events(spark, folder).select("user_id", "session_id", "event_type", "timestamp")
    return topics.to_envelope(rows, "user_id")


_RECORD = StructType().add("id", "long").add("event_type", "string").add("value", "double")
HANDLERS = {
    "user_events": lambda d: topics.parse_json(d, _RECORD).select(
        E.value_band(F.col("value")).alias("label")),
    "analytics_events": lambda d: topics.parse_json(d, _RECORD).select(
        F.col("event_type").alias("label")),
}


def _records(events: DataFrame) -> DataFrame:
    """Events as records of two topics."""
    kind = F.get_json_object("value", "$.event_type")
    return topics.to_envelope(events.select("id", "event_type", "value"), "id").withColumn(
        "topic", F.when(kind == "error", "analytics_events").otherwise("user_events"))


def _by_topic(results: dict[str, DataFrame]) -> DataFrame:
    """Rows per label and topic of the handlers' results."""
    parts = [d.select("label", F.lit(t).alias("topic")) for t, d in results.items()]
    return reduce(DataFrame.unionByName, parts).groupBy("label", "topic").agg(
        F.count("*").alias("n"))


@query("topic_handlers")
def _(spark, folder):
    return _by_topic(topics.route(_records(_events(spark, folder)), HANDLERS))


# ---- joins ------------------------------------------------------------------------------------

_simple("user_dim", A.user_dim, customers=True)
_simple("user_dim_join", lambda e: A.with_user_dim(e).select(
    "id", "user_id", "value", "user_country", "user_events"), customers=True)


@query("session_analysis")
def _(spark, folder):
    return P.session_analysis(model.user_sessions(spark, folder),
                              _events(spark, folder, pages=True), AS_OF, "view")


# ---- aggregates -------------------------------------------------------------------------------

_simple("user_metrics", lambda e: A.user_metrics(e, CENTS))


@query("session_analytics")
def _(spark, folder):
    e = _events(spark, folder, customers=True)
    return A.session_analytics(
        e.withColumn("device_type", E.device_type(F.col("user_agent"))), CENTS)


_simple("hourly_resample", lambda e: A.hourly_resample(e, CENTS))
_simple("rolling_24h", lambda e: A.rolling_24h(e, CENTS).select(
    "hour", "value_sum_rolling_24h", "user_id_nunique_rolling_24h"))
_simple("resample_sum", lambda e: A.resample_sum(e, CENTS))
_simple("groupby_user", lambda e: A.sum_by_user(e, CENTS))
_simple("groupby_session", lambda e: A.mean_by_session(e, CENTS))
_simple("daily_activity", lambda e: A.daily_activity(e, AS_OF))
_simple("user_activity", lambda e: A.user_activity(e, AS_OF))
_simple("hourly_metrics", lambda e: P.hourly_metrics(e, AS_OF, "7 days", completion="signup"))
_simple("minute_metrics", lambda e: P.minute_metrics(e, AS_OF, "24 hours"))
_simple("time_windows", lambda e: P.time_windows(e, AS_OF))
_simple("user_weeks", P.user_weeks)
_simple("cohort_retention", P.cohort_retention)
query("cohort_orders")(lambda s, f: P.cohort_retention(model.order_events(s, f)))
_simple("funnel", lambda e: P.funnel(e, AS_OF, FUNNEL_STEPS))
_simple("funnel_ordered", lambda e: P.ordered_funnel(e, AS_OF, FUNNEL_STEPS))
_simple("funnel_ordered_users", lambda e: P.ordered_funnel(e, AS_OF, FUNNEL_STEPS, keys=("user_id",)))
_simple("event_statistics", A.event_statistics)
_simple("event_type_counts", jobs.type_counts)
_simple("kpis", lambda e: A.kpis(e, AS_OF, CENTS))
_simple("kpis_between", lambda e: A.kpis(between(
    e, "timestamp", "2024-01-10 00:00:00", "2024-01-17 00:00:00"), "2024-01-17 00:00:00", CENTS))
_simple("user_zscore", lambda e: A.user_zscore(e, CENTS))
_simple("top_event_types", lambda e: A.value_counts(e, "event_type", 5))
_simple("country_distribution", lambda e: A.value_counts(e, "country", 10), customers=True)
_simple("device_distribution", lambda e: A.value_counts(
    e.withColumn("device_type", E.device_type(F.col("user_agent"))), "device_type"))
_simple("hour_of_day", A.hour_of_day)
_simple("event_share", A.event_share)
_simple("events_timeline", A.events_timeline)
_simple("live_kpis", A.live_kpis)
_simple("engagement_histogram", A.engagement_histogram)
_simple("users_by_country", A.users_by_country, customers=True)


@query("apply_all")
def _(spark, folder):
    """Several transforms of one frame; here their results side by side."""
    done = apply_all(_events(spark, folder), {
        "by_type": lambda e: A.value_counts(e, "event_type").select(
            F.col("event_type").alias("label"), "n"),
        "by_hour": lambda e: A.hour_of_day(e).select(F.col("hour").cast("string").alias("label"), "n"),
    })
    return done["by_type"].withColumn("result", F.lit("by_type")).unionByName(
        done["by_hour"].withColumn("result", F.lit("by_hour")))


# ---- windows ----------------------------------------------------------------------------------

_simple("session_metrics", lambda e: S.session_metrics(e).select(
    "id", "session_id", "session_start", "session_end", "session_duration", "page_views",
    "unique_pages"), pages=True)
_simple("trailing_counts", lambda e: TR.trailing_activity(e, users=False).select(
    "id", "events_5min", "events_1hour"))
_simple("trailing_users", lambda e: TR.trailing_activity(e, counts=False).select(
    "id", "unique_users_5min", "unique_users_1hour"))
_simple("burst_anomaly", lambda e: TR.bursts(e, 86_400, 2).select(
    "id", "user_id", "current_events", "avg_events", "is_anomaly"))
_simple("burst_default", lambda e: TR.bursts(e).select(
    "id", "user_id", "current_events", "avg_events", "is_anomaly"))
_simple("event_sequence", lambda e: R.numbered(
    e, ["user_id", "session_id"], "timestamp", "id", "event_sequence"
).select("id", "user_id", "session_id", "event_sequence"))
_simple("ranked_users", A.ranked_users)

PROCESSED = ["id", "user_id", "session_id", "clean_page_url", "device_type", "browser", "session_start", "session_end",
             "session_duration", "page_views", "unique_pages", "events_5min", "events_1hour", "unique_users_5min",
             "unique_users_1hour", "current_events", "avg_events", "is_anomaly"]
_simple("processed_events", lambda e: batch.processed_events(e).select(*PROCESSED), pages=True)
# A session is a user's day here, so none reaches further than a day.
_simple("processed_last_hour", lambda e: batch.processed_between(
    e, "2024-01-30 23:00:00", AS_OF, "1 day").select(*PROCESSED), pages=True)


# ---- metrics ----------------------------------------------------------------------------------

def _metric_query(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, folder: fn(model.analytics_metrics(spark, folder)))


_metric_query("metric_summary", lambda m: M.metric_summary(m, scale=CENTS))
_metric_query("metric_change", lambda m: M.metric_change(m).select(
    "id", "metric_name", "metric_value", "previous_value", "change_percent", "is_significant"))
_metric_query("metric_rollup_5m", lambda m: M.rollup(m, scale=CENTS))
_metric_query("metric_align_reduce", lambda m: M.align_reduce(m, scale=CENTS))
_metric_query("metric_align_label", lambda m: M.align_reduce(
    m, "1 day", scale=CENTS, labels={"k": "7"}))
_metric_query("latest_metric", lambda m: M.latest_metric(m, AS_OF, "1 hour", CENTS))


def _health(spark, folder) -> DataFrame:
    """Per country and day, one component per event type, judged by its largest value."""
    e = _events(spark, folder, customers=True)
    top = F.max("value")
    status = e.groupBy("country", F.date_trunc("day", "timestamp").alias("day"), "event_type").agg(
        F.when(top > 200, "error").when(top > 100, "unavailable").otherwise("healthy")
        .alias("status"))
    return M.health_rollup(status, ["country", "day"])


query("health_rollup")(_health)
_simple("error_rate_alerts", lambda e: M.alerts(M.event_measures(e)))
query("health_alerts")(lambda s, f: M.alerts(M.health_measures(_health(s, f), "day")).groupBy(
    "window_start", "metric", "severity").agg(F.sum("num").alias("failed")))


# ---- quality ----------------------------------------------------------------------------------

PROFILED = ["user_id", "event_type", "value", "event_data"]
_simple("column_profile", lambda e: Q.column_profile(e, PROFILED))
_simple("column_top_values", lambda e: Q.top_values(e, PROFILED, 10))
_simple("order_correlation", lambda e: Q.order_correlation(e, ["user_id", "value"], "id"))


@query("quality_scores")
def _(spark, folder):
    good = model.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return Q.quality_scores(
        _events(spark, folder), good, AS_OF, "28 days",
        ["id", "user_id", "session_id", "event_type", "timestamp", "user_agent"],
        [t for t in EVENT_TYPES if t != "error"], {"event_data": 1000, "user_agent": 60})


@query("partition_skew")
def _(spark, folder):
    events = model.table(spark, folder, "events")
    sizes = Q.partition_sizes(events, F.to_date("ts"))
    return Q.partition_skew(sizes).withColumns({c: F.round(c, 6) for c in ("avg_bytes", "std_bytes")})


# ---- tables and files -------------------------------------------------------------------------

@query("matview")
def _(spark, folder):
    """Daily totals stored behind a view, refreshed once by a query over the same events."""
    view = warehouse.MaterializedView(
        spark, f"daily_totals_{uuid.uuid4().hex[:8]}",
        "SELECT to_date(timestamp) AS day, event_type, count(*) AS n FROM {events} GROUP BY ALL",
        {"events": _events(spark, folder)})
    return view.create().refresh().read()


@query("partitioned_scan")
def _(spark, folder):
    """Last week of a date-partitioned copy; the scan reads only those folders."""
    path = _fresh(spark, "events_by_date")
    warehouse.write_partitioned(_events(spark, folder).select(
        "id", "event_type", "timestamp", "value"), path, "timestamp")
    return spark.read.parquet(path).where("event_date >= date'2024-01-24'").groupBy(
        "event_date", "event_type").agg(F.count("*").alias("n"))


@query("replaced_day")
def _(spark, folder):
    """A partitioned copy after one day was delivered again, without its errors."""
    path = _fresh(spark, "events_by_date")
    rows = _events(spark, folder).select("id", "event_type", "timestamp", "value")
    warehouse.write_partitioned(rows, path, "timestamp")
    day = between(rows, "timestamp", "2024-01-15 00:00:00", "2024-01-16 00:00:00").where("event_type != 'error'")
    warehouse.write_partitioned(day, path, "timestamp", replace="days")
    return files.read_files(spark, path).groupBy("event_date", "event_type").agg(F.count("*").alias("n"))


@query("retention_partitions")
def _(spark, folder):
    """Days of a partitioned copy that can go, told by their folders."""
    path = _fresh(spark, "events_by_date")
    warehouse.write_partitioned(_events(spark, folder).select("id", "timestamp"), path, "timestamp")
    return warehouse.partition_expiry(spark, path, AS_OF, 14)


def _daily_parts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("day", "event_type").agg(
        F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.max(F.struct("timestamp", "id")).alias("newest"))


def _daily_merge(parts: DataFrame) -> DataFrame:
    return parts.groupBy("event_type").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.max("newest").getField("id").alias("newest_id"))


@query("daily_view")
def _(spark, folder):
    """Totals per type kept from daily parts, refreshed when only some of the days were there, and again."""
    rows = _events(spark, folder).select("id", "event_type", "timestamp", "value")
    view = warehouse.DailyView(spark, _fresh(spark, "daily"), _daily_parts, _daily_merge)
    view.refresh(between(rows, "timestamp", "2024-01-01 00:00:00", "2024-01-20 12:00:00"))
    return view.refresh(rows).read()


@query("topic_attributes")
def _(spark, folder):
    """Messages with attributes, through topic files and back."""
    path = _fresh(spark, "topic")
    rows = _events(spark, folder).select("id", "user_id", "event_type", "user_agent")
    files.write_files(topics.to_envelope(rows, "user_id", ["event_type", "user_agent"]), path, "json")
    back = spark.read.schema(f"key string, value string, headers {topics.HEADERS}").json(path)
    return back.withColumn("a", topics.attributes()).groupBy(
        F.col("a")["event_type"].alias("event_type"), F.col("a")["user_agent"].alias("user_agent"),
        F.size("a").cast("long").alias("attributes")).agg(F.count("*").alias("n"))


_simple("retention_expired", lambda e: files.retention_counts(e, "timestamp", AS_OF, 14))


def _round_trip(fmt: str) -> Query:
    def run(spark, folder):
        rows = zoneless(_events(spark, folder).select("id", "event_type", "timestamp", "value"))
        path = _fresh(spark, f"events_{fmt}")
        files.write_files(rows, path, fmt)
        return files.read_files(spark, path, fmt, rows.schema)

    return run


for _fmt in ("parquet", "json", "csv"):
    query(f"round_trip_{_fmt}")(_round_trip(_fmt))


@query("snapshot")
def _(spark, folder):
    root = _fresh(spark, "snapshots")
    path = files.snapshot(model.table(spark, folder, "events"), root, "events", date(2024, 1, 31))
    return files.read_files(spark, path).select("event_id", "user_id", "event_type", "value")


@query("snapshot_changes")
def _(spark, folder):
    """A second copy after one row changed and a day went: only these days are new, and the copy is whole."""
    rows = model.table(spark, folder, "events")
    copies = files.Snapshots(spark, _fresh(spark, "copies"), F.to_date("ts"), rows.columns)
    copies.copy(rows, 0)
    later = rows.where("to_date(ts) != date'2024-01-20'").withColumn(
        "value", F.when(F.col("event_id") == 0, -1.0).otherwise(F.col("value")))
    changes = copies.copy(later, 1)
    broken = copies.verify(1).select("part", F.lit("broken").alias("change"))
    return changes.unionByName(broken)


# ---- streams ----------------------------------------------------------------------------------

_simple("sliding_counts", lambda e: jobs.sliding_counts(e))


def _stream(spark, folder) -> DataFrame:
    raw = io.table_stream(spark, f"{folder}/events.parquet", model.table(spark, folder, "events").schema)
    return model.model_events(raw.withColumn("ts", F.col("ts").cast("timestamp")))


@query("stream_enrich")
def _(spark, folder):
    out = _fresh(spark, "stream")
    rows = E.enrich_events(_stream(spark, folder).withColumn("page_url", F.lit(None).cast("string")))
    io.finish(io.to_parquet(rows.select("id", "device_type", "browser", "timestamp"),
                            f"{out}/rows", f"{out}/cp", None))
    return spark.read.parquet(f"{out}/rows")


_STREAMED = (StructType().add("id", "long").add("user_id", "byte").add("event_type", "string").add("cents", "short")
             .add("timestamp", "timestamp").add("page_url", "string").add("user_agent", "string"))


def _quarantine(spark, folder):
    """The events as topic records, in a stream that sorts out the broken ones; processed at AS_OF."""
    e = _stream(spark, folder).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    records = topics.to_envelope(e.select("id", "user_id", "event_type", "cents", "timestamp", "user_agent"), "user_id")
    kind = F.get_json_object("value", "$.event_type")
    records = records.withColumns({
        "topic": F.when(kind == "signup", "signups").otherwise("user_events"),
        "offset": F.get_json_object("value", "$.id").cast("long")})
    sinks = jobs.quarantined(_fresh(spark, "stream"), _STREAMED, ["user_events"], clock=AS_OF)
    io.finish(jobs.run_stream(records, sinks, Settings(), once=True))
    return sinks


@query("stream_events")
def _(spark, folder):
    return _quarantine(spark, folder).read(spark, "events", jobs.event_output(_STREAMED)).select(
        "id", F.col("user_id").cast("long"), "event_type", F.col("cents").cast("long"), "timestamp", "device_type", "browser")


@query("stream_dead_letters")
def _(spark, folder):
    return _quarantine(spark, folder).read(spark, "dead_letters", jobs.DEAD_LETTERS).select(
        "offset", "key", "topic", "reason", F.get_json_object("value", "$.cents").cast("long").alias("cents"))


@query("run_alerts")
def _(spark, folder):
    """Alerts from what the stream's own writes measured, for batches of at most 10,000 rows."""
    commits = _quarantine(spark, folder).commits(spark, jobs.MEASURED)
    return M.alerts(M.run_measures(commits, 10_000))


@query("stream_type_counts")
def _(spark, folder):
    out = _fresh(spark, "stream")
    io.finish(io.for_each(jobs.type_counts(_stream(spark, folder)),
                          io.changed_rows(f"{out}/rows"), f"{out}/cp", "update", None))
    return io.current_rows(spark, f"{out}/rows", ["event_type"])


@query("stream_sliding_counts")
def _(spark, folder):
    """The windows closed by the watermark."""
    out = _fresh(spark, "stream")
    rows = jobs.sliding_counts(_stream(spark, folder), watermark="1 hour")
    io.finish(io.to_parquet(rows, f"{out}/rows", f"{out}/cp", None))
    return spark.read.parquet(f"{out}/rows")


@query("stream_user_sessions")
def _(spark, folder):
    out = _fresh(spark, "stream")
    rows = jobs.new_sessions(_stream(spark, folder), "1 hour")
    io.finish(io.to_parquet(rows, f"{out}/rows", f"{out}/cp", None))
    return jobs.sessions_per_user(spark.read.parquet(f"{out}/rows"))


@query("stream_session_counts")
def _(spark, folder):
    """Sessions per user and day, for the days closed by the watermark, in one stream query."""
    out = _fresh(spark, "stream")
    rows = jobs.session_counts(_stream(spark, folder), 86_400, 2 * 86_400)
    io.finish(io.to_parquet(rows, f"{out}/rows", f"{out}/cp", None))
    return spark.read.parquet(f"{out}/rows")


@query("stream_session_totals")
def _(spark, folder):
    """Sketches of sessions per day, merged: the estimate of all sessions against their exact number."""
    out = _fresh(spark, "stream")
    rows = jobs.session_sketches(_stream(spark, folder), "1 day", "1 day")
    io.finish(io.to_parquet(rows, f"{out}/rows", f"{out}/cp", None))
    closed = spark.read.parquet(f"{out}/rows")
    exact = _events(spark, folder).groupBy(F.date_trunc("day", "timestamp").alias("window_start"), "user_id", "session_id").agg(
        F.count("*")).groupBy("window_start").agg(F.count("*").alias("sessions"))
    both = closed.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).join(
        exact.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), "window_start")
    return both.agg(F.count("*").alias("days"), F.sum("sessions").alias("sessions"),
                    (F.abs(F.hll_sketch_estimate(F.hll_union_agg("sketch")) - F.sum("sessions"))
                     <= F.sum("sessions") * jobs.SKETCH_ERROR).alias("within_error"))


@query("stream_dedup")
def _(spark, folder):
    """The events delivered twice, kept once."""
    out = _fresh(spark, "stream")
    twice = _stream(spark, folder).unionByName(_stream(spark, folder))
    rows = jobs.deduplicated(twice, "1 hour").select("id", "event_type", "timestamp")
    io.finish(io.to_parquet(rows, f"{out}/rows", f"{out}/cp", None))
    return spark.read.parquet(f"{out}/rows")


@query("stream_topics")
def _(spark, folder):
    """Two topics of one stream, each through its handler to its own sink."""
    out = _fresh(spark, "stream")
    sinks = {topic: io.changed_rows(f"{out}/{topic}") for topic in HANDLERS}
    io.finish(io.for_each(_records(_stream(spark, folder)), jobs.routed(HANDLERS, sinks),
                          f"{out}/cp", trigger_seconds=None))
    return _by_topic({topic: spark.read.parquet(f"{out}/{topic}") for topic in HANDLERS})


@query("stream_metric_change")
def _(spark, folder):
    out = _fresh(spark, "stream")
    rows = _stream(spark, folder).select(
        "id", F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"),
        "timestamp")
    io.finish(io.for_each(rows, jobs.metric_changes(f"{out}/rows", f"{out}/state", f"{out}/late"), f"{out}/cp",
                          trigger_seconds=None))
    return spark.read.parquet(f"{out}/rows").drop("batch", "timestamp")
