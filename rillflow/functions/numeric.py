"""Exact counting and money arithmetic as Spark expressions.

A distributed sum of doubles depends on the order in which partitions arrive. Where the number of
decimals of a measure is known (``scale``), the helpers add up whole units (value * 10^scale) as
integers, so a result is the same for every partitioning and every retry. With ``scale=None`` they
are Spark's plain double aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType


def div(a, b) -> Column:
    """Integer division (truncating)."""
    return F.call_function("div", a, b)


def pct2(num: Column, den: Column) -> Column:
    """100 * num / den rounded half up to two decimals; null when den is 0. Counts only."""
    num, den = num.cast("long"), F.nullif(den.cast("long"), F.lit(0).cast("long"))
    return div(F.lit(20000) * num + den, F.lit(2) * den) / F.lit(100.0)


def units(value: Column, scale: int) -> Column:
    """The value as a whole number of 10^-scale."""
    return F.round(value * F.lit(10 ** scale)).cast("long")


def exact_sum(value: Column, scale: int | None) -> Column:
    if scale is None:
        return F.sum(value)
    return F.sum(units(value, scale)).cast("double") / F.lit(float(10 ** scale))


def exact_mean(value: Column, scale: int | None) -> Column:
    if scale is None:
        return F.avg(value)
    n = F.nullif(F.count(value), F.lit(0).cast("long"))
    return F.sum(units(value, scale)).cast("double") / n / F.lit(float(10 ** scale))


def sum_squares(unit: Column) -> Column:
    wide = unit.cast(DecimalType(19, 0))
    return F.sum((wide * wide).cast(DecimalType(38, 0)))


def spread(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, an integer sum and an integer sum of squares."""
    n_dec, s_dec = n.cast(DecimalType(19, 0)), total.cast(DecimalType(19, 0))
    top = n_dec * squares.cast(DecimalType(38, 0)) - (s_dec * s_dec).cast(DecimalType(38, 0))
    bottom = n.cast("double") * (n - F.lit(1)).cast("double")
    return F.when(n > 1, F.sqrt(top.cast("double") / F.nullif(bottom, F.lit(0.0))))


def exact_std(value: Column, scale: int | None) -> Column:
    if scale is None:
        return F.stddev_samp(value)
    unit = units(value, scale)
    return spread(F.count(value), F.sum(unit), sum_squares(unit)) / F.lit(float(10 ** scale))


def mean_units(total: Column, n: Column, extra: int = 4) -> Column:
    """total / n as an integer with `extra` more decimals than the units of total, half up."""
    top = F.lit(2 * 10 ** extra) * total + n
    return div(top - F.pmod(top, F.lit(2) * n), F.lit(2) * n)
