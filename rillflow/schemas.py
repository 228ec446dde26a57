"""Schemas of the event model: topics, payloads and tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in cols])


USER_EVENT = _struct(
    ("user_id", _S, True), ("session_id", _S, True), ("event_type", _S, True),
    ("event_data", _S, True), ("timestamp", _TS, True), ("ip_address", _S, True),
    ("user_agent", _S, True), ("page_url", _S, True), ("referrer", _S, True),
)

ANALYTICS_EVENT = _struct(
    ("metric_name", _S, True), ("metric_value", _D, True), ("dimensions", _S, True),
    ("timestamp", _TS, True), ("source", _S, True),
)

# What a topic source delivers for each record.
ENVELOPE = _struct(
    ("key", _S, True), ("value", _S, True), ("topic", _S, True),
    ("partition", _I, True), ("offset", T.LongType(), True), ("timestamp", _TS, True),
)

# Union of the JSON payload fields of all event types, so that one parse serves every type.
EVENT_DATA = _struct(
    ("page_load_time", _I, True), ("viewport_width", _I, True), ("viewport_height", _I, True),
    ("time_on_page", _I, True), ("scroll_depth", _I, True),
    ("element_id", _S, True), ("element_class", _S, True),
    ("click_position", _struct(("x", _I, True), ("y", _I, True)), True),
    ("video_id", _S, True), ("video_duration", _I, True), ("video_quality", _S, True),
    ("search_query", _S, True), ("search_results_count", _I, True),
    ("order_id", _S, True), ("total_amount", _D, True), ("currency", _S, True),
    ("items_count", _I, True),
)

USER_EVENTS_TABLE = _struct(
    ("id", T.LongType(), False), ("user_id", _S, False), ("session_id", _S, False),
    ("event_type", _S, False), ("event_data", _S, True), ("timestamp", _TS, False),
    ("ip_address", _S, True), ("user_agent", _S, True), ("page_url", _S, True),
    ("referrer", _S, True), ("device_type", _S, True), ("browser", _S, True),
    ("country", _S, True), ("created_at", _TS, True),
)

USER_SESSIONS_TABLE = _struct(
    ("id", T.LongType(), False), ("session_id", _S, False), ("user_id", _S, False),
    ("start_time", _TS, False), ("end_time", _TS, True), ("duration_seconds", _I, True),
    ("page_views", _I, True), ("unique_pages", _I, True), ("device_type", _S, True),
    ("country", _S, True), ("created_at", _TS, True),
)

ANALYTICS_METRICS_TABLE = _struct(
    ("id", T.LongType(), False), ("metric_name", _S, False), ("metric_value", _D, False),
    ("dimensions", _S, True), ("timestamp", _TS, False), ("source", _S, True),
    ("created_at", _TS, True),
)

TABLES = {
    "user_events": USER_EVENTS_TABLE,
    "user_sessions": USER_SESSIONS_TABLE,
    "analytics_metrics": ANALYTICS_METRICS_TABLE,
}

# Longest string the user_events columns may hold.
MAX_LENGTH = {
    "user_id": 50, "session_id": 50, "event_type": 50, "event_data": 1000,
    "ip_address": 45, "user_agent": 500, "page_url": 500, "referrer": 500,
    "device_type": 20, "browser": 50, "country": 10,
}

# The event types of the model.
EVENT_TYPES = [
    "page_view", "click", "scroll", "video_play", "video_pause", "video_complete", "search",
    "purchase", "add_to_cart", "remove_from_cart", "login", "logout", "signup", "share",
    "like", "comment", "follow",
]
