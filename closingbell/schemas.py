"""Table schemas, keys and integrity rules, as data.

Parquet enforces none of these, so the audits and the writers read them from here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
    "array<string>": ArrayType(StringType()),
}


def _table(columns: str) -> StructType:
    """Schema from ``name type`` pairs (Spark's own DDL reader needs a running session)."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


TICKERS = _table("ticker string, universe string")

LANDING = _table(
    "symbol string, status_code int, body string, seq bigint, fetched_at timestamp_ntz"
)

BAR = _table(
    "symbol string, date date, open double, high double, low double, close double, volume bigint"
)

PRICES = _table(
    "symbol string, date date, open double, high double, low double, close double,"
    " volume bigint, year int"
)

CALENDAR = _table("session_date date")

UNIVERSE = _table(
    "id string, name string, description string, created_at timestamp_ntz"
)

MEMBERSHIP = _table(
    "id string, symbol string, created_at timestamp_ntz, updated_at timestamp_ntz"
)

UNIVERSE_MEMBERSHIP = _table(
    "id string, membership_id string, universe_id string, enter_date date, exit_date date,"
    " created_at timestamp_ntz, updated_at timestamp_ntz, delisted_reason string"
)

VOLATILITY = _table(
    "id string, symbol_id string, created_at timestamp_ntz, updated_at timestamp_ntz,"
    " rolling_sd double, rolling_avg_volume double"
)

# The newest bars of every symbol: what a baseline is computed from.
RECENT_BARS = _table("symbol string, date date, close double, volume bigint")

FAILED_INGESTION = _table(
    "id string, symbol_id string, raw_symbol string, created_at timestamp_ntz, failure string,"
    " failure_error string, retry_after timestamp_ntz, attempts int, review_required boolean"
)

FLAG = _table(
    "id string, symbol_id string, session_date date, pipeline_run_id string,"
    " rules array<string>, prev_close double, log_return double, log_return_limit double,"
    " open_gap double, open_gap_limit double, volume bigint, volume_limit double,"
    " rolling_sd double, rolling_avg_volume double, created_at timestamp_ntz"
)

PIPELINE_RUN = _table(
    "id string, dag_id string, run_date date, status string, started_at timestamp_ntz,"
    " completed_at timestamp_ntz, records_processed int, records_failed int, notes string"
)

TABLES = {
    "universe": UNIVERSE,
    "membership": MEMBERSHIP,
    "universe_membership": UNIVERSE_MEMBERSHIP,
    "volatility_rolling": VOLATILITY,
    "recent_bars": RECENT_BARS,
    "failed_ingestion": FAILED_INGESTION,
    "ohlcv_flag": FLAG,
    "pipeline_run": PIPELINE_RUN,
}

# States of a run, classes of a failure.
RUN_STATES = ("RUNNING", "SUCCESS", "FAILED", "PARTIAL")
FAILURE_CLASSES = ("HTTP_ERROR", "VALIDATION")

UNIQUE_KEYS = {
    "universe": ["name"],
    "membership": ["symbol"],
    "volatility_rolling": ["symbol_id"],
    "recent_bars": ["symbol", "date"],
    "failed_ingestion": ["symbol_id"],
    "ohlcv_flag": ["symbol_id", "session_date"],
    "pipeline_run": ["id"],
    "prices": ["symbol", "date"],
}

# Unique only among rows whose exit_date is null.
ACTIVE_KEYS = {"universe_membership": ["membership_id", "universe_id"]}

# child table -> [(child column, parent table, parent column)]
FOREIGN_KEYS = {
    "universe_membership": [
        ("membership_id", "membership", "id"),
        ("universe_id", "universe", "id"),
    ],
    "volatility_rolling": [("symbol_id", "membership", "id")],
    "failed_ingestion": [("symbol_id", "membership", "id")],
    "ohlcv_flag": [("symbol_id", "membership", "id")],
}

ACCEPTED_VALUES = {
    "pipeline_run": {"status": RUN_STATES},
    "failed_ingestion": {"failure": FAILURE_CLASSES},
}

NOT_NULL = {
    "universe": ["name"],
    "membership": ["symbol"],
    "universe_membership": ["membership_id", "universe_id", "enter_date"],
    "volatility_rolling": ["symbol_id", "rolling_sd", "rolling_avg_volume"],
    "ohlcv_flag": ["symbol_id", "session_date", "rules"],
    "pipeline_run": ["dag_id", "run_date"],
}

MAX_LENGTH = {
    "universe": {"name": 50},
    "membership": {"symbol": 10},
    "failed_ingestion": {"raw_symbol": 10},
    "pipeline_run": {"dag_id": 100, "status": 20},
}

# Column defaults applied to nulls when a row is first stored.
DEFAULTS = {
    "failed_ingestion": {"attempts": 0, "review_required": False},
    "pipeline_run": {"records_processed": 0, "records_failed": 0},
}
CLOCK_DEFAULTS = {
    "universe": ["created_at"],
    "membership": ["created_at", "updated_at"],
    "universe_membership": ["created_at", "updated_at"],
    "volatility_rolling": ["created_at", "updated_at"],
    "failed_ingestion": ["created_at"],
    "ohlcv_flag": ["created_at"],
    "pipeline_run": ["started_at"],
}


def clock(now) -> Column:
    """The run's clock as a zone-less timestamp; every operator takes it explicitly."""
    if isinstance(now, Column):
        return now.cast("timestamp_ntz")
    return F.lit(str(now)).cast("timestamp_ntz")


def conform(df: DataFrame, table: str, now=None) -> DataFrame:
    """New rows in the stored column order and types, with the column defaults filled in."""
    schema = TABLES[table]
    defaults = {name: F.lit(value) for name, value in DEFAULTS.get(table, {}).items()}
    if now is not None:
        defaults.update({name: clock(now) for name in CLOCK_DEFAULTS.get(table, [])})
    columns = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)
