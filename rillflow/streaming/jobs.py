"""Stream transforms. Row-level work is the batch code; only stateful parts differ."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.timefn import SECOND, cell, micros
from ..operators.enrich import enrich_events, enriched_columns
from ..operators.metrics import metric_change, newest
from ..config import Settings
from ..schemas import ENVELOPE
from ..sources.topics import Handler, check_messages, good_messages, route
from . import io
from .commits import Sinks


def enriched(messages: DataFrame, schema: StructType, topics: list[str] | None = None) -> DataFrame:
    """The good topic records as enriched events. Broken ones are left to `quarantined`."""
    return enrich_events(good_messages(check_messages(messages, schema, topics)))


def quarantined(root: str, schema: StructType, topics: list[str], enrich: bool = True,
                clock: str | None = None, ts: str = "timestamp") -> Sinks:
    """Two outputs of topic records: `events`, the good ones (enriched), and `dead_letters`, the others with
    the reason, in one write per batch. Each batch also records the rows of both, the good ones that are
    errors, its newest event time and its processing time (`clock`: a fixed one), in microseconds.
    """
    now = F.current_timestamp() if clock is None else F.lit(clock).cast("timestamp")
    field = {f.name: F.col(f"data.{f.name}") for f in schema.fields}
    good = [c.alias(n) for n, c in field.items()]
    if enrich:
        good += [c.alias(n) for n, c in enriched_columns(field["page_url"], field["user_agent"]).items()]
    bad = [F.col(f.name) for f in ENVELOPE.fields] + [F.col("reason")]

    def checked(batch: DataFrame) -> DataFrame:
        missing = {f.name: F.lit(None).cast(f.dataType) for f in ENVELOPE.fields if f.name not in batch.columns}
        rows = check_messages(batch.withColumns(missing), schema, topics)
        return rows.withColumn("data", F.when(F.col("reason").isNull(), F.col("data")))

    errors = F.count_if(field["event_type"] == "error") if "event_type" in field else F.count_if(F.lit(False))
    measures = (errors.alias("errors"), F.max(F.unix_micros(field[ts].cast("timestamp"))).alias("newest"),
                F.min(F.unix_micros(now)).alias("processed_at"))
    return Sinks(root, {"events": (F.col("reason").isNull(), good), "dead_letters": (F.col("reason").isNotNull(), bad)},
                 measures, checked)


#: What `quarantined` records of each batch beyond the rows of the outputs.
MEASURED = "rows_events long, rows_dead_letters long, errors long, newest long, processed_at long"


def event_output(schema: StructType, enrich: bool = True) -> StructType:
    added = ("clean_page_url", "device_type", "browser") if enrich else ()
    return StructType([*schema.fields, *[StructField(n, StringType()) for n in added]])


DEAD_LETTERS = StructType([*ENVELOPE.fields, StructField("reason", StringType())])


def run_stream(messages: DataFrame, sinks: Sinks, settings: Settings, once: bool = False):
    """Starts the processing stream: trigger interval from the settings, checkpoint next to the data."""
    return io.for_each(messages, sinks.write, f"{sinks.root}/checkpoint",
                       trigger_seconds=None if once else settings.checkpoint_interval)


def configured_counts(events: DataFrame, settings: Settings) -> DataFrame:
    """`sliding_counts` with window, slide and watermark of the settings."""
    return sliding_counts(events, window_seconds=settings.window_duration,
                          slide_seconds=settings.slide_duration, watermark=settings.watermark)


def sliding_counts(events: DataFrame, ts: str = "timestamp", window_seconds: int = 300,
                   slide_seconds: int = 60, watermark: str | None = None) -> DataFrame:
    """Events per type in sliding windows. With a watermark, closed windows are final."""
    if watermark:
        events = events.withWatermark(ts, watermark)
    return events.groupBy(
        F.window(ts, f"{window_seconds} seconds", f"{slide_seconds} seconds").alias("w"),
        "event_type",
    ).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "event_type", "n")


def type_counts(events: DataFrame) -> DataFrame:
    """Running count per event type (update mode)."""
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def new_sessions(events: DataFrame, watermark: str, ts: str = "timestamp") -> DataFrame:
    """(user, session) pairs, each once within the watermark: bounded state.

    A pair that returns after the watermark is emitted again, so exact counts are taken as distinct
    pairs over the written output (see sessions_per_user).
    """
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(
        ["user_id", "session_id"]).select("user_id", "session_id")


def sessions_per_user(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("user_id").agg(F.countDistinct("session_id").alias("sessions"))


def session_counts(events: DataFrame, window_seconds: int, delay_seconds: int, ts: str = "timestamp") -> DataFrame:
    """Exact sessions per user and window, each emitted when the watermark closes the window.

    Two stateful operators in one query: (window, user, session) once each, then a count. The state holds
    open windows only. The watermark's delay must be as long as the window at least: then a pair is
    remembered until other rows of its window would be late anyway.
    """
    if delay_seconds < window_seconds:
        raise ValueError("the delay must be as long as the window")
    rows = events.withWatermark(ts, f"{delay_seconds} seconds").select(
        ts, "user_id", "session_id", cell(micros(ts), window_seconds * SECOND).alias("cell"))
    first = rows.dropDuplicatesWithinWatermark(["cell", "user_id", "session_id"])
    return first.groupBy(F.window(ts, f"{window_seconds} seconds").alias("w"), "user_id").agg(
        F.count("*").alias("sessions")).select(F.col("w.start").alias("window_start"), "user_id", "sessions")


#: Three standard errors of a sketch of 2**12 registers (the default of hll_sketch_agg): 3 * 1.04 / sqrt(4096).
SKETCH_ERROR = 0.05


def session_sketches(events: DataFrame, window: str, delay: str, ts: str = "timestamp") -> DataFrame:
    """A sketch of the distinct (user, session) pairs per closed window. Sketches of any windows can be merged
    later with hll_union_agg, which counts of windows cannot."""
    pair = F.concat_ws("/", F.col("user_id").cast("string"), F.col("session_id").cast("string"))
    return events.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("w")).agg(
        F.hll_sketch_agg(pair).alias("sketch")).select(F.col("w.start").alias("window_start"), "sketch")


def approx_sessions(events: DataFrame, watermark: str, window: str = "1 day",
                    ts: str = "timestamp") -> DataFrame:
    """Sessions per user and window with a fixed-size sketch instead of a growing set."""
    return events.withWatermark(ts, watermark).groupBy(
        F.window(ts, window).alias("w"), "user_id"
    ).agg(F.approx_count_distinct("session_id").alias("sessions")).select(
        F.col("w.start").alias("window_start"), "user_id", "sessions")


def deduplicated(events: DataFrame, watermark: str, key: str = "id",
                 ts: str = "timestamp") -> DataFrame:
    """Events once each, also when the source delivers them again within the watermark."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def routed(handlers: dict[str, Handler],
           sinks: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: every topic's handler result to that topic's sink, one read."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for topic, result in route(batch, handlers).items():
                sinks[topic](result, batch_id)
        finally:
            batch.unpersist()

    return handle


def metric_changes(out: str, state: str, late: str, delay_seconds: int = 3600,
                   threshold: float = 20.0) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: change alerts across batches.

    Between batches a table in the shared folder keeps all rows newer than the watermark (the
    latest time seen less `delay_seconds`) and of each metric the last row before it, so a row that
    is no later than that finds its previous value. Rows older than the watermark are not judged
    but written to `late`. Inside a batch the batch operators do the work, so a metric with
    a third of all rows is spread over many tasks. Batch n reads the state slot of n - 1 and
    overwrites its own, so a repeated batch gives the same result.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_known", F.lit(False))
        if batch_id > 0:
            before = spark.read.schema(batch.schema).parquet(f"{state}/slot={(batch_id - 1) % 2}")
            mark = before.agg(F.max("timestamp")).first()[0]
            if mark is not None:
                since = F.lit(mark - timedelta(seconds=delay_seconds))
                rows.where(F.col("timestamp") < since).drop("_known").write.mode(
                    "overwrite").parquet(f"{late}/batch={batch_id}")
                rows = rows.where(F.coalesce(F.col("timestamp") >= since, F.lit(True)))
            rows = rows.unionByName(before.withColumn("_known", F.lit(True)))
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            metric_change(rows, threshold).where(~F.col("_known")).drop("_known").write.mode(
                "overwrite").parquet(f"{out}/batch={batch_id}")
            top = rows.agg(F.max("timestamp")).first()[0]
            kept = rows
            if top is not None:
                since = F.lit(top - timedelta(seconds=delay_seconds))
                new = F.coalesce(F.col("timestamp") >= since, F.lit(False))
                kept = rows.where(new).unionByName(newest(rows.where(~new), 1).select(rows.columns))
            kept.drop("_known").write.mode("overwrite").parquet(f"{state}/slot={batch_id % 2}")
        finally:
            rows.unpersist()

    return handle
