"""Vendor payloads landed as ``(symbol, status_code, body, seq, fetched_at)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell.functions import candle_date

FIELDS = ("open", "high", "low", "close", "volume")

PAYLOAD = (
    "empty boolean, candles array<struct<datetime:double,"
    + ",".join(f"{name}:double" for name in FIELDS)
    + ">>, damaged string"
)


def parse_candles(landing: DataFrame) -> DataFrame:
    """Each payload's last candle beside the payload, parsed once and on the JVM.

    ``damaged`` holds the body when nothing could be read from it. A body with one odd
    field still yields its candle: that field is null and the field gate names it.
    """
    parsed = landing.withColumn(
        "payload", F.from_json("body", PAYLOAD, {"columnNameOfCorruptRecord": "damaged"})
    )
    candle = F.try_element_at("payload.candles", F.lit(-1))
    unreadable = F.col("payload").isNull() | (
        F.col("payload.damaged").isNotNull() & F.col("payload.candles").isNull()
    )
    return parsed.select(
        *landing.columns,
        unreadable.alias("unreadable"),
        (
            F.coalesce(F.col("payload.empty"), F.lit(False))
            | (F.coalesce(F.size("payload.candles"), F.lit(0)) <= 0)
        ).alias("no_candles"),
        candle.alias("candle"),
    ).select(
        *landing.columns,
        "unreadable",
        "no_candles",
        candle_date(F.col("candle.datetime")).alias("date"),
        *[F.col(f"candle.{name}").alias(name) for name in FIELDS],
    )
