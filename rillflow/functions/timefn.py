"""Time expressions shared by batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts) -> Column:
    """Microseconds since the epoch: the integer ordering key of an event."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def cell(us, size: int) -> Column:
    """Start of the fixed cell of `size` microseconds that holds `us` (floors before 1970 too)."""
    if isinstance(us, str):
        return F.expr(f"{us} - pmod({us}, {size}L)")
    return us - F.pmod(us, F.lit(size))


def moment(df: DataFrame, ts: str, text: str) -> Column:
    """A literal of the column's own type, so that comparisons with it reach the Parquet reader."""
    ntz = isinstance(df.schema[ts].dataType, TimestampNTZType)
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def ago(df: DataFrame, ts: str, as_of: str, span: str) -> Column:
    """as_of - span, for example '30 days'."""
    return moment(df, ts, as_of) - F.expr(f"interval {span}")


def since(df: DataFrame, ts: str, as_of: str, span: str) -> DataFrame:
    """Rows with ts >= as_of - span."""
    return df.where(F.col(ts) >= ago(df, ts, as_of, span))


def between(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with start <= ts < end."""
    return df.where((F.col(ts) >= moment(df, ts, start)) & (F.col(ts) < moment(df, ts, end)))


def zoneless(df: DataFrame) -> DataFrame:
    """All timestamps as wall-clock UTC, the type the tables are stored in."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ])
