"""Ingestion gates: every payload becomes one typed bar or one classified rejection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from closingbell.functions import not_positive, shown, shown_number, whole_volume
from closingbell.operators.calendar import with_previous_session
from closingbell.sources.payloads import FIELDS, parse_candles

# How much of an error body a message keeps, and the message formats.
ERROR_BODY_CHARS = 200
MESSAGES = {
    "status": "%s: HTTP %s — %s",
    "unreadable": "%s: unparseable response from vendor",
    "empty": "%s: empty response from vendor",
    "date": "%s: candle date %s != expected %s",
    "field": "%s: field '%s' missing or non-positive (got %s)",
    "high": "%s: high %s does not dominate open=%s close=%s low=%s",
    "low": "%s: low %s does not undercut open=%s close=%s",
}

RAW_CANDLES = "candles array<struct<" + ",".join(f"{name}:string" for name in FIELDS) + ">>"


def _message(message: str, *parts: Column) -> Column:
    return F.format_string(MESSAGES[message], F.col("symbol"), *parts)


def _as_sent(field: str) -> Column:
    """The field as the vendor wrote it. Read again from the body, but only for a payload
    that failed on it."""
    last = F.try_element_at(F.from_json("body", RAW_CANDLES)["candles"], F.lit(-1))
    return shown(last[field])


def _other_status() -> Column:
    return ~F.col("status_code").eqNullSafe(200)


def _bad_field(name: str) -> Column:
    bad = not_positive(F.col(name))
    return bad | whole_volume(F.col(name)).isNull() if name == "volume" else bad


def _not_dominated() -> Column:
    return ~reduce(lambda a, b: a & b, [F.col("high") >= F.col(name) for name in ("open", "close", "low")])


def _not_undercut() -> Column:
    return ~((F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close")))


def gate() -> Column:
    """The first gate that a payload fails, by name; comparisons only."""
    expected = F.col("prev_session")
    return (
        F.when(_other_status() | F.col("unreadable") | F.col("no_candles"), "http")
        .when(expected.isNull() | ~F.col("date").eqNullSafe(expected), "session_date")
        .when(reduce(lambda a, b: a | b, map(_bad_field, FIELDS)), "positive")
        .when(_not_dominated() | _not_undercut(), "ohlc")
    )


def failure_error() -> Column:
    """The message of a payload whose ``gate`` is known."""
    http = (
        F.when(
            _other_status(),
            _message("status", shown(F.col("status_code")),
                     F.substring(F.coalesce("body", F.lit("")), 1, ERROR_BODY_CHARS)),
        )
        .when(F.col("unreadable"), _message("unreadable"))
        .otherwise(_message("empty"))
    )
    # fields in order; the first missing or non-positive one names the rejection
    positive = F.coalesce(
        *(F.when(_bad_field(name), _message("field", F.lit(name), _as_sent(name))) for name in FIELDS)
    )
    prices = {name: shown_number(F.col(name)) for name in ("open", "high", "low", "close")}
    ohlc = F.when(
        _not_dominated(), _message("high", prices["high"], prices["open"], prices["close"], prices["low"])
    ).otherwise(_message("low", prices["low"], prices["open"], prices["close"]))
    date = _message("date", shown(F.col("date")), shown(F.col("prev_session")))
    failed = F.col("gate")
    return (
        F.when(failed == "http", http)
        .when(failed == "session_date", date)
        .when(failed == "positive", positive)
        .when(failed == "ohlc", ohlc)
    )


def gate_payloads(landing: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per payload: ``symbol``, ``seq``, the candle's fields, and for a rejected one
    ``gate``, ``failure`` and ``failure_error`` (null for a good bar). Bodies stay behind.

    The first failing gate decides. Gates are expressions over the row, so one bad payload
    never stops another and a symbol with most of the payloads spreads over all tasks. A filter
    on ``gate`` runs before the messages are formatted.
    """
    parsed = parse_candles(landing).withColumn("fetched_on", F.to_date("fetched_at"))
    gated = with_previous_session(parsed, "fetched_on", calendar).withColumn("gate", gate())
    failure = F.when(F.col("gate") == "http", "HTTP_ERROR").when(F.col("gate").isNotNull(), "VALIDATION")
    return gated.select(
        "symbol", "seq", "date", *FIELDS, "gate",
        failure.alias("failure"), failure_error().alias("failure_error"),
    )


def accepted_bars(gated: DataFrame) -> DataFrame:
    """Bars that passed, still with their arrival order ``seq``."""
    return gated.filter(F.col("gate").isNull()).select(
        "symbol", "date", "open", "high", "low", "close",
        whole_volume(F.col("volume")).alias("volume"), "seq",
    )


def rejections(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("gate").isNotNull()).select(
        "symbol", "seq", "gate", "failure", "failure_error"
    )


def keep_last(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """The last arrival of each key.

    Planned with a group limit on both sides of the shuffle: each map task sends at most
    one row of a key, so any number of copies of one key is cheap.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc() for name in arrival])
    return (
        df.withColumn("__nth", F.row_number().over(latest))
        .filter("__nth = 1")
        .drop("__nth")
    )


def union_chunks(chunks: list[DataFrame]) -> DataFrame:
    """Results of separately gated chunks as one frame; columns are matched by name."""
    return reduce(lambda a, b: a.unionByName(b), chunks)
