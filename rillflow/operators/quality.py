"""Column profiles, data-quality scores and partition size reports."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DecimalType

from ..functions.numeric import pct2, units
from ..functions.timefn import ago
from ..schemas import EVENT_TYPES, MAX_LENGTH, USER_EVENTS_TABLE

REQUIRED = [f.name for f in USER_EVENTS_TABLE.fields if not f.nullable]

# Lowest score of each grade.
GRADES = [(96.0, "Excellent"), (90.0, "Good"), (80.0, "Fair")]


def _long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows with every value as text, one scan for all columns."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns])).alias("c")).select("c.*")


def column_profile(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Per column: rows, nulls, distinct values, smallest and largest value (as text).

    The approximate form is one wide aggregate. The exact form counts rows per (column, value)
    first, so that columns with few values shrink before the shuffle and columns with many are
    spread over all tasks; the columns are then told apart by conditions instead of a grouping,
    which would sort all values by column.
    """
    if exact:
        df = _long_form(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    facts = []
    for c in columns:
        mine = F.col("column_name") == c if exact else F.lit(True)
        value = F.when(mine, F.col("value")) if exact else F.col(c).cast("string")
        weight = F.when(mine, F.col("n")) if exact else F.lit(1)
        facts.append(F.struct(
            F.lit(c).alias("column_name"),
            F.coalesce(F.sum(weight), F.expr("0L")).alias("rows"),
            F.coalesce(F.sum(F.when(value.isNull(), weight)), F.expr("0L")).alias("nulls"),
            (F.count(value) if exact else F.approx_count_distinct(value)).alias("distinct_values"),
            F.min(value).alias("min_value"), F.max(value).alias("max_value")))
    return df.agg(F.array(*facts).alias("c")).select(F.inline("c"))


def top_values(df: DataFrame, columns: list[str], top: int = 10) -> DataFrame:
    """The most common values of each column and their share of all rows, in percent."""
    n = _long_form(df, columns).where("value is not null").groupBy("column_name", "value").agg(
        F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    w = W.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    return n.withColumn("position", F.row_number().over(w)).where(
        F.col("position") <= top).withColumn("frequency_pct", pct2(F.col("n"), total))


def order_correlation(df: DataFrame, columns: list[str], order: str, decimals: int = 6) -> DataFrame:
    """Correlation of numeric columns with an ordering column, rounded; null for constants.

    Values are taken from the column's minimum, exactly, and then in doubles by one-pass moments:
    ids of any size and any number of rows neither overflow nor lose their small differences.
    """
    low = df.agg(*[F.min(c).alias(f"_{i}") for i, c in enumerate([order, *columns])]).first()

    def above(c: str, m) -> Column:
        if isinstance(m, int):
            wide = DecimalType(38, 0)
            return (F.col(c).cast(wide) - F.lit(m).cast(wide)).cast("double")
        return F.col(c).cast("double") - F.lit(m).cast("double")

    rows = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), above(c, m).alias("x"), above(order, low[0]).alias("y"))
        for c, m in zip(columns, low[1:])])).alias("r")).select("r.*")
    spread = F.stddev_pop("x") * F.stddev_pop("y")
    return rows.where("x is not null and y is not null").groupBy("column_name").agg(
        F.round(F.try_divide(F.covar_pop("x", "y"), spread), decimals).alias("correlation"))


def grade(score: Column) -> Column:
    out = None
    for low, name in GRADES:
        out = F.when(score >= low, name) if out is None else out.when(score >= low, name)
    return out.otherwise("Poor")


def quality_scores(events: DataFrame, known_users: DataFrame, as_of: str, max_age: str,
                   keys: list[str] = REQUIRED, event_types: list[str] = EVENT_TYPES,
                   lengths: dict[str, int] = MAX_LENGTH) -> DataFrame:
    """completeness, accuracy, consistency, timeliness and validity in percent, with a grade.

    completeness: key columns all present; accuracy: the user exists in `known_users(user_id)`;
    consistency: distinct ids per row; timeliness: not older than `max_age` at `as_of`;
    validity: a known event type and no over-long text. Row rules share one scan. The user check
    joins event counts per user, the id check counts ids, so neither depends on how skewed users
    are.
    """
    fresh = F.col("timestamp") >= ago(events, "timestamp", as_of, max_age)
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    valid = reduce(Column.__and__, [
        F.coalesce(F.length(F.col(c)) <= n, F.lit(True)) for c, n in lengths.items()
    ], F.coalesce(F.col("event_type").isin(event_types), F.lit(False)))
    rows = events.agg(
        F.count("*").alias("n"), F.count_if(present).alias("completeness"),
        F.count_if(fresh).alias("timeliness"), F.count_if(valid).alias("validity"))
    row_rules = rows.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).alias("num"), F.col("n").alias("den"))
        for m in ("completeness", "timeliness", "validity")])).alias("m")).select("m.*")

    per_user = events.groupBy("user_id").agg(F.count("*").alias("n"))
    known = known_users.select("user_id").distinct().withColumn("_known", F.lit(True))
    accuracy = per_user.join(known, "user_id", "left").agg(
        F.lit("accuracy").alias("metric"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("n"))),
                   F.lit(0).cast("long")).alias("num"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("den"))
    consistency = events.groupBy("id").agg(F.count("*").alias("n")).agg(
        F.lit("consistency").alias("metric"), F.count("*").alias("num"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("den"))
    scored = row_rules.unionByName(accuracy).unionByName(consistency).withColumn(
        "score", pct2(F.col("num"), F.col("den")))
    return scored.select("metric", "score", grade(F.col("score")).alias("status"))


def row_bytes(df: DataFrame) -> Column:
    """Size of a row's values: the width of fixed types, the bytes of texts; nulls have none."""
    width = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}
    sizes = [F.octet_length(n) if kind in ("string", "binary") else F.when(F.col(n).isNotNull(), F.lit(width.get(kind, 8)))
             for n, kind in df.dtypes]
    return reduce(add, [F.coalesce(c, F.lit(0)).cast("long") for c in sizes])


def partition_sizes(df: DataFrame, by: Column) -> DataFrame:
    """Rows and bytes of the values per partition of the table, for example per day. No row is
    turned into text, and the sizes do not depend on how the scan is split."""
    return df.groupBy(by.alias("partition")).agg(F.count("*").alias("rows"), F.sum(row_bytes(df)).alias("bytes"))


def scan_splits(df: DataFrame) -> DataFrame:
    """Rows per file split that a scan of files reads, from the metadata of the source."""
    m = F.col("_metadata")
    return df.groupBy(m.file_path.alias("file"), m.file_block_start.alias("start"), m.file_block_length.alias("bytes")).agg(
        F.count("*").alias("rows"))


def partition_memory(df: DataFrame) -> DataFrame:
    """Rows and in-memory pandas size per partition, batch by batch (bounded memory)."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, rows, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            rows += len(batch)
            size += int(batch.memory_usage(deep=True, index=False).sum())
        yield pd.DataFrame({"partition": [part], "rows": [rows], "bytes": [size]})

    return df.mapInPandas(measure, "partition int, rows long, bytes long")


def partition_skew(sizes: DataFrame) -> DataFrame:
    """Total, mean, largest, smallest and spread of the partition sizes (one row per partition)."""
    b = F.col("bytes")
    return sizes.agg(
        F.sum("rows").alias("total_rows"), F.sum(b).alias("total_bytes"),
        F.avg(b).alias("avg_bytes"), F.max(b).alias("max_bytes"), F.min(b).alias("min_bytes"),
        F.stddev_samp(b).alias("std_bytes"), F.count("*").alias("partition_count"))
