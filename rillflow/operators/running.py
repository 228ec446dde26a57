"""Row order and previous values over time without putting a whole key into one task.

A window ordered by time over one key is a single task, however many rows the key has. Here time
is cut into fixed cells: only the rows inside one (key, cell) are ordered together, and what a cell
needs from earlier ones comes from a window over one summary row per cell.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.timefn import MINUTE, cell, micros


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on `keys` in which null equals null; `right` is unique on them."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(named, on, "left").drop(*[f"_r_{k}" for k in keys])


def numbered(rows: DataFrame, keys: list[str], ts: str, tie: str, name: str,
             size: int = MINUTE) -> DataFrame:
    """ROW_NUMBER per key in (ts, tie) order; a key may be of any size, a cell is one task's work."""
    cut = rows.withColumn("_cell", cell(micros(ts), size))
    counts = cut.groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    earlier = W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(
        *keys, "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    w = W.partitionBy(*keys, "_cell").orderBy(ts, tie)
    return (
        same_keys(cut.withColumn("_rn", F.row_number().over(w)), starts, [*keys, "_cell"])
        .withColumn(name, F.col("_rn") + F.col("_before"))
        .drop("_cell", "_rn", "_before")
    )


def with_previous(rows: DataFrame, key: str, ts: str, tie: str, value: str, name: str,
                  size: int = MINUTE) -> DataFrame:
    """LAG(value) per key in (ts, tie) order. Each cell gets the last value of the cell before."""
    cut = rows.withColumn("_cell", cell(micros(ts), size))
    last = cut.groupBy(key, "_cell").agg(
        F.max(F.struct(ts, tie, value)).getField(value).alias("_last"))
    carried = last.withColumn(
        "_carry", F.lag("_last").over(W.partitionBy(key).orderBy("_cell"))).drop("_last")
    w = W.partitionBy(key, "_cell").orderBy(ts, tie)
    inside = cut.withColumns({
        "_lag": F.lag(value).over(w), "_first": F.row_number().over(w) == 1})
    return same_keys(inside, carried, [key, "_cell"]).withColumn(
        name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))
    ).drop("_cell", "_lag", "_first", "_carry")
