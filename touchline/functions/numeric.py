"""Aggregates and formats whose result does not depend on the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_sum(value: Column, digits: int) -> Column:
    """Sum of a value with ``digits`` decimals, as an exact integer count of its last unit.

    A plain sum of doubles depends on how rows are split over tasks; this one does not.
    """
    return F.sum(F.round(value * F.lit(float(10**digits))).cast("bigint"))


def mean_from_scaled(total: Column, count: Column, digits: int) -> Column:
    return F.when(count > 0, total / (F.lit(float(10**digits)) * count))


def exact_mean(value: Column, digits: int) -> Column:
    return mean_from_scaled(scaled_sum(value, digits), F.count(value), digits)


def clock(seconds: Column) -> Column:
    """Whole seconds as ``MM:SS``; more than 99 minutes keep all their digits."""
    minutes = F.floor(seconds / 60).cast("bigint")
    rest = F.floor(seconds % 60).cast("bigint").cast("string")
    digits = minutes.cast("string")
    padded = F.when(minutes < 10, F.lpad(digits, 2, "0")).otherwise(digits)
    return F.concat(padded, F.lit(":"), F.lpad(rest, 2, "0"))
