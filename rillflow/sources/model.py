"""The event model on top of the stored tables (events, pages, customer, nation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.enrich import device_type

# User agents by the payload's k modulo 5; null where there is none.
AGENTS = [
    "Mozilla/5.0 (Linux; Android 10) Chrome/91.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Android 10; Tablet) Firefox/89.0",
    "Mozilla/5.0 (Macintosh) Version/14.1 Safari/605.1",
    "Opera/9.80 (Windows NT 6.1) Presto/2.12",
    None,
]
FUNNEL_STEPS = [("View", "view"), ("Click", "click"), ("Signup", "signup"),
                ("Purchase", "purchase")]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
AS_OF = "2024-01-31 00:00:00"


# Stored columns; a declared schema saves the read of file footers before every query.
COLUMNS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
    "pages": "page_id long, url string, html string",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _agent(props: Column) -> Column:
    k = F.pmod(F.get_json_object(props, "$.k").cast("int"), F.lit(len(AGENTS)))
    return F.get(F.array(*[F.lit(text).cast("string") for text in AGENTS]), k)


def model_events(raw: DataFrame) -> DataFrame:
    """The columns of the model that come from the events table alone."""
    return raw.select(
        F.col("event_id").alias("id"), "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"),
                    F.to_date("ts").cast("string")).alias("session_id"),
        "event_type", F.col("props").alias("event_data"), F.col("ts").alias("timestamp"),
        "value", _agent(F.col("props")).alias("user_agent"),
    )


def user_events(spark: SparkSession, folder: str, pages: bool = False,
                customers: bool = False) -> DataFrame:
    """user_events; page_url with `pages`, country and category with `customers`.

    A join is only added when its columns are asked for. The lookup tables grow with the data, so
    there is no broadcast hint: Spark decides from their measured size, and a join that shuffles
    has plain scans on both sides, which adaptive execution splits when a user is hot.
    """
    e = model_events(table(spark, folder, "events"))
    if pages:
        p = table(spark, folder, "pages").select("page_id", F.col("url").alias("page_url"))
        size = p.agg(F.count("*")).scalar()
        e = e.withColumn("page_id", F.pmod("id", size)).join(p, "page_id", "left").drop("page_id")
    if customers:
        c = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("user_id"), "c_nationkey",
            F.col("c_mktsegment").alias("category"))
        n = table(spark, folder, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
        e = e.join(c, "user_id", "left").join(n, "c_nationkey", "left").drop("c_nationkey")
    return e


def with_payloads(events: DataFrame) -> DataFrame:
    """user_events whose event_data has the payload of the type, from the other columns: purchases their amount
    and items, views as videos with a duration, clicks as searches. Every fifth k leaves fields out."""
    k = F.get_json_object("event_data", "$.k").cast("int")
    kind, whole, cents = F.col("event_type"), k % 5 != 0, F.round(F.col("value") * 100).cast("int")
    fields = {
        "purchase": {"order_id": F.concat(F.lit("o"), "id"), "total_amount": F.col("value"), "currency": F.lit("USD"),
                     "items_count": F.when(whole, 1 + k % 9)},
        "view": {"video_id": F.concat(F.lit("v"), k), "video_duration": F.when(whole, cents)},
        "click": {"search_query": F.when(whole, F.concat(F.lit("user "), "user_id")), "search_results_count": k},
    }
    texts = [F.when(kind == name, F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()])))
             for name, cols in fields.items()]
    return events.withColumn("event_data", F.coalesce(*texts, F.lit("{}")))


def user_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """user_sessions, derived from the events: one row per session."""
    e = user_events(spark, folder, pages=True)
    first = F.min(F.struct("timestamp", "id", "user_id", "user_agent"))
    who = e.groupBy("session_id").agg(
        first.getField("user_id").alias("user_id"),
        device_type(first.getField("user_agent")).alias("device_type"),
        F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"),
        F.count("*").alias("page_views"), F.countDistinct("page_url").alias("unique_pages"),
        (F.unix_seconds(F.max("timestamp").cast("timestamp"))
         - F.unix_seconds(F.min("timestamp").cast("timestamp"))).alias("duration_seconds"),
    )
    c = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    return who.join(c, "user_id", "left").join(n, "n_nationkey", "left").drop("n_nationkey")


def analytics_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """analytics_metrics: the event values as a metric per event type."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("metric_name"),
        F.col("value").alias("metric_value"), F.col("props").alias("dimensions"),
        F.col("ts").alias("timestamp"), F.lit("events").alias("source"))


def order_events(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' orders as events: several years, so that weeks cross year ends."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"))
