from __future__ import annotations

from pyspark.sql import Column, functions as F


def missing(value: Column) -> Column:
    """Null or NaN. Spark sorts NaN above every number, so comparisons alone let it pass."""
    return value.isNull() | F.isnan(value)


def not_positive(value: Column) -> Column:
    return missing(value) | (value <= 0)


def whole_volume(value: Column) -> Column:
    """Volume truncated toward zero; null when it does not fit a 64-bit count."""
    return value.try_cast("bigint")
