"""Topic sources and sinks: envelope, JSON decode, dead letters, routing."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..config import Settings

# ISO text with microseconds, as events carry it on the wire.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def kafka_options(settings: Settings, topics: list[str], starting: str = "latest",
                  headers: bool = False) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": settings.kafka_bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if settings.poll_records:
        options["maxOffsetsPerTrigger"] = str(settings.poll_records)
    if headers:
        options["includeHeaders"] = "true"
    return options


def read_topics(spark: SparkSession, settings: Settings, topics: list[str],
                starting: str = "latest", headers: bool = False) -> DataFrame:
    """A stream over one or more topics (needs the Kafka connector on the class path)."""
    return spark.readStream.format("kafka").options(
        **kafka_options(settings, topics, starting, headers)).load()


def write_topic(df: DataFrame, settings: Settings, topic: str) -> None:
    """Publishes an envelope (key, value and, where there are any, headers) to a topic."""
    df.select(*[c for c in ("key", "value", "headers") if c in df.columns]).write.format("kafka").option(
        "kafka.bootstrap.servers", settings.kafka_bootstrap_servers).option("topic", topic).save()


#: Record headers as the topic source and sink have them.
HEADERS = "array<struct<key: string, value: binary>>"


def to_envelope(df: DataFrame, key: str, attributes: list[str] | None = None) -> DataFrame:
    """Rows as keyed JSON messages; `attributes` become headers, without those that are null."""
    cols = [
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("*"), {"timestampFormat": WIRE_TIME,
                                  "timestampNTZFormat": WIRE_TIME}).alias("value"),
    ]
    if attributes:
        pairs = F.array(*[F.struct(F.lit(a).alias("key"), F.col(a).cast("string").cast("binary").alias("value"))
                          for a in attributes])
        cols.append(F.filter(pairs, lambda p: p.value.isNotNull()).cast(HEADERS).alias("headers"))
    return df.select(*cols)


def attributes(headers: str = "headers") -> Column:
    """The headers as a map of texts; the last one counts where a name comes twice."""
    entries = F.transform(F.coalesce(headers, F.array().cast(HEADERS)), lambda h: F.struct(h.key, h.value.cast("string")))
    return F.aggregate(entries, F.create_map().cast("map<string, string>"), lambda m, e: F.map_concat(
        F.map_filter(m, lambda k, _: k != e.key), F.map_from_entries(F.array(e))))


def typed_fields(v: Column, schema: StructType) -> tuple[Column, Column]:
    """The fields of a VARIANT object as a struct, and whether any is there that does not fit its type.

    A number out of the range of its type, or a text that is no number, does not fit; a missing or null
    field is null and fits.
    """
    fields, misfits = [], []
    for f in schema.fields:
        path = f"$['{f.name}']"
        value = F.try_variant_get(v, path, f.dataType.simpleString())
        fields.append(value.alias(f.name))
        there = F.try_variant_get(v, path, "variant")
        misfits.append(value.isNull() & there.isNotNull() & ~F.is_variant_null(there))
    return F.struct(*fields), reduce(or_, misfits, F.lit(False))


def check_messages(df: DataFrame, schema: StructType, topics: list[str] | None = None) -> DataFrame:
    """Adds `data` and `reason`: null for a good message, else why it cannot be handled.

    A message is good if its value is a JSON object whose fields fit the schema; the text is parsed once, to
    a VARIANT, and what stands behind the object is not looked at. `topics`: those that are handled, null for any.
    """
    rows = df.withColumn("_v", F.try_parse_json(F.col("value").cast("string")))
    v = F.col("_v")
    data, misfit = typed_fields(v, schema)
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    reason = F.when(~whole | misfit, "bad message")
    if topics is not None:
        known = F.coalesce(F.col("topic").isin(topics), F.lit(False))
        reason = F.when(~known, "unknown topic").otherwise(reason)
    return rows.withColumn("data", F.when(whole, data)).withColumn("reason", reason).drop("_v")


def good_messages(checked: DataFrame) -> DataFrame:
    return checked.where("reason is null").select("data.*")


def parse_json(df: DataFrame, schema: StructType) -> DataFrame:
    """The fields of the good messages; broken ones go to `dead_letters`, not into the events."""
    return good_messages(check_messages(df, schema))


def dead_letters(checked: DataFrame) -> DataFrame:
    return checked.where("reason is not null").drop("data")


Handler = Callable[[DataFrame], DataFrame]


def route(df: DataFrame, handlers: dict[str, Handler]) -> dict[str, DataFrame]:
    """One result per topic: the handler applied to the messages of that topic."""
    return {topic: fn(df.where(F.col("topic") == topic)) for topic, fn in handlers.items()}
