"""Small frames for the golden tests."""

from __future__ import annotations

import datetime as dt
import json

from closingbell import schemas

DAY = dt.date(2024, 1, 2)
NOW = "2024-01-03 06:30:00"


def epoch_ms(day: dt.date, hour: int = 5) -> int:
    return int(dt.datetime(day.year, day.month, day.day, hour, tzinfo=dt.timezone.utc).timestamp()) * 1000


def candle(day=DAY, **fields) -> dict:
    good = {"datetime": epoch_ms(day), "open": 100, "high": 106, "low": 99, "close": 105, "volume": 500}
    return good | fields


def body(*candles, **top) -> str:
    return json.dumps({"empty": False, "candles": list(candles)} | top)


def landing(spark, rows):
    """``rows``: (symbol, status, body) with the arrival order of the list."""
    at = dt.datetime(2024, 1, 3, 6, 30)
    return spark.createDataFrame(
        [(symbol, status, text, seq, at) for seq, (symbol, status, text) in enumerate(rows)],
        schemas.LANDING,
    )


def calendar(spark):
    days = [dt.date(2023, 12, 28), dt.date(2023, 12, 29), DAY, dt.date(2024, 1, 3)]
    return spark.createDataFrame([(day,) for day in days], schemas.CALENDAR)


def bars(spark, symbol, closes, start=dt.date(2023, 11, 1), volume=1000, volumes=None):
    rows = []
    for i, close in enumerate(closes):
        day = start + dt.timedelta(days=i)
        rows.append((symbol, day, close, close, close, close, volumes[i] if volumes else volume))
    return spark.createDataFrame(rows, schemas.BAR)


def membership(spark, *symbols):
    at = dt.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [(f"id-{symbol}", symbol, at, at) for symbol in symbols], schemas.MEMBERSHIP
    )


def stints(spark, rows):
    """``rows``: (symbol, universe, enter, exit)."""
    at = dt.datetime(2020, 1, 1)
    return spark.createDataFrame(
        [
            (f"um-{i}", f"id-{symbol}", universe, enter, left, at, at, None)
            for i, (symbol, universe, enter, left) in enumerate(rows)
        ],
        schemas.UNIVERSE_MEMBERSHIP,
    )


def empty(spark, table):
    return spark.createDataFrame([], schemas.TABLES[table])
