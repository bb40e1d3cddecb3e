from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Last millisecond of the year 9999; a larger candle time is not a date.
LAST_EPOCH_MS = 253402300799999


def as_date(value) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def session_year(date: Column) -> Column:
    return F.year(date).cast("int")


def recent_years(as_of: dt.date | str) -> list[int]:
    """The two year partitions a look-back of some tens of sessions can reach."""
    year = dt.date.fromisoformat(str(as_of)).year
    return [year - 1, year]


def candle_date(epoch_ms: Column) -> Column:
    """UTC date of an epoch-milliseconds value; null when it is missing or out of range."""
    in_range = (F.abs(epoch_ms) <= F.lit(LAST_EPOCH_MS)) & ~F.isnan(epoch_ms)
    # unix days need no session time zone: floor to whole days, then add to the epoch
    days = F.floor(F.when(in_range, epoch_ms) / F.lit(86400000.0)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)
