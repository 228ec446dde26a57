"""Row-level enrichment, filters and payload decoding (used unchanged by batch and streams)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StringType

from ..schemas import EVENT_DATA

# Markers in order of precedence.
DEVICES = ["Mobile", "Tablet"]
BROWSERS = ["Chrome", "Firefox", "Safari"]
IMPORTANT_TYPES = ["purchase", "signup", "login"]
ESSENTIAL_COLUMNS = [
    "user_id", "session_id", "event_type", "timestamp", "page_url", "device_type", "browser",
]


def _first_marker(text: Column, markers: list[str], default: str) -> Column:
    return F.coalesce(
        *[F.when(text.contains(m), F.lit(m)) for m in markers], F.lit(default)
    )


def clean_url(url: Column) -> Column:
    """Drops scheme and host, wherever they occur in the text."""
    return F.regexp_replace(url, r"https?://[^/]+", "")


def device_type(agent: Column) -> Column:
    return _first_marker(agent, DEVICES, "Desktop")


def browser(agent: Column) -> Column:
    return _first_marker(agent, BROWSERS, "Other")


def enriched_columns(page_url: Column, user_agent: Column) -> dict[str, Column]:
    return {
        "clean_page_url": clean_url(page_url),
        "device_type": device_type(user_agent),
        "browser": browser(user_agent),
    }


def enrich_events(df: DataFrame) -> DataFrame:
    """Adds clean_page_url, device_type and browser."""
    return df.withColumns(enriched_columns(F.col("page_url"), F.col("user_agent")))


def value_band(value: Column) -> Column:
    """low below 5, medium below 15, else high; null stays null."""
    return F.when(value < 5, "low").when(value < 15, "medium").when(value.isNotNull(), "high")


def register_value_band(spark: SparkSession, name: str = "value_band") -> str:
    """The same bands as a function for SQL users. A SQL function is inlined into the plan, so it costs what
    the expression costs."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(v DOUBLE) RETURNS STRING
        RETURN CASE WHEN v < 5 THEN 'low' WHEN v < 15 THEN 'medium' WHEN v IS NOT NULL THEN 'high' END""")
    return name


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds hour, day_of_week (Monday = 0), is_weekend and value_category."""
    day = F.weekday(ts)
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": day,
        "is_weekend": day.isin(5, 6),
        "value_category": value_band(F.col("value")),
    })


def essential_columns(df: DataFrame) -> DataFrame:
    return df.select(*ESSENTIAL_COLUMNS)


def high_value(df: DataFrame, above: float = 20) -> DataFrame:
    return df.where(F.col("value") > above)


def important_events(df: DataFrame, types: list[str] = IMPORTANT_TYPES) -> DataFrame:
    return df.where(F.col("event_type").isin(*types))


def recent_events(df: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """One page of the newest events (a top-k: each task keeps offset + limit rows)."""
    return (
        df.orderBy(F.col("timestamp").desc(), F.col("id").desc()).offset(offset).limit(limit)
    )


def with_payload(df: DataFrame) -> DataFrame:
    """Parses event_data once, to a VARIANT that serves every event type; null where it is no JSON."""
    return df.withColumn("payload", F.try_parse_json("event_data"))


def _field(name: str, default=None) -> Column:
    kind = EVENT_DATA[name].dataType.simpleString()
    value = F.try_variant_get("payload", f"$.{name}", kind)
    return value if default is None else F.coalesce(value, F.lit(default))


def broken_payloads(df: DataFrame) -> DataFrame:
    """Rows whose event_data is there but no JSON."""
    return with_payload(df).where("event_data IS NOT NULL AND payload IS NULL").drop("payload")


def purchase_payload(df: DataFrame) -> DataFrame:
    """Amount and item count of purchases, 0 where the payload does not name them."""
    p = with_payload(df.where(F.col("event_type") == "purchase"))
    return p.withColumns({
        "total_amount": _field("total_amount", 0.0), "items_count": _field("items_count", 0),
    }).drop("payload")


def typed_payload(df: DataFrame, video_type: str = "video_complete",
                  search_type: str = "search") -> DataFrame:
    """Video and search fields with their defaults; null for events of other types."""
    kind = F.col("event_type")
    return with_payload(df).withColumns({
        "video_id": F.when(kind == video_type, _field("video_id")),
        "video_duration": F.when(kind == video_type, _field("video_duration", 0)),
        "search_query": F.when(kind == search_type, _field("search_query", "")),
        "search_results_count": F.when(kind == search_type, _field("search_results_count", 0)),
    }).drop("payload")


def metric_dimensions(df: DataFrame) -> DataFrame:
    """dimensions JSON as a map of strings; an empty map where there is none, null where broken."""
    text = F.coalesce("dimensions", F.lit("{}"))
    return df.withColumn("dims", F.from_json(text, MapType(StringType(), StringType())))
