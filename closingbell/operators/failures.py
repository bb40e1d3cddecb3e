"""Dead-letter queue: what is broken right now, one row per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell import schemas
from closingbell.functions import stable_id
from closingbell.operators import keyed, universe

# Attempts after which somebody has to look, and the retry delay.
REVIEW_ATTEMPTS = 3
RETRY_DELAY = "INTERVAL 1 HOUR"


def record_failures(
    dlq: DataFrame, failures: DataFrame, membership: DataFrame, now
) -> DataFrame:
    """The queue after a batch of ``(symbol, seq, failure, failure_error)``.

    n failures of a symbol add n attempts and the last one in ``seq`` order is kept. They
    are folded to one row per symbol before any shuffle or join, so a symbol that fails for
    most of the batch costs one row per map task. The raw symbol and id of a known row stay.
    """
    last = F.max_by(F.struct("failure", "failure_error"), F.struct("seq", "failure", "failure_error"))
    folded = failures.groupBy("symbol").agg(
        F.count("*").cast("int").alias("attempts"), last.alias("last")
    )
    at = schemas.clock(now)
    changes = universe.symbol_lookup(folded, membership).select(
        stable_id("failed_ingestion", F.col("symbol_id"), at).alias("id"),
        "symbol_id",
        F.col("symbol").alias("raw_symbol"),
        "last.failure",
        "last.failure_error",
        (at + F.expr(RETRY_DELAY)).alias("retry_after"),
        "attempts",
        (F.col("attempts") >= REVIEW_ATTEMPTS).alias("review_required"),
    )
    attempts = F.col("old.attempts") + F.col("new.attempts")
    return keyed.upsert(
        dlq,
        schemas.conform(changes, "failed_ingestion", now),
        ["symbol_id"],
        update={
            "failure": F.col("new.failure"),
            "failure_error": F.col("new.failure_error"),
            "retry_after": F.col("new.retry_after"),
            "attempts": attempts,
            "review_required": attempts >= REVIEW_ATTEMPTS,
            "created_at": F.col("new.created_at"),
        },
    )


def clear_resolved(dlq: DataFrame, written: DataFrame, membership: DataFrame) -> DataFrame:
    """The queue without the symbols that reached the price store."""
    landed = universe.symbol_lookup(written.select("symbol").distinct(), membership)
    return keyed.delete_matching(dlq, landed, ["symbol_id"])


def count_since(dlq: DataFrame, since) -> DataFrame:
    return dlq.filter(F.col("created_at") >= schemas.clock(since)).agg(
        F.count("*").alias("failures")
    )


def update_baselines(
    volatility: DataFrame, rolling: DataFrame, membership: DataFrame, now
) -> DataFrame:
    """Stored baselines after a run; a symbol without a new baseline keeps its old row."""
    rows = universe.symbol_lookup(rolling, membership).select(
        stable_id("volatility_rolling", F.col("symbol_id")).alias("id"),
        "symbol_id", "rolling_sd", "rolling_avg_volume",
    )
    return keyed.upsert(
        volatility,
        schemas.conform(rows, "volatility_rolling", now),
        ["symbol_id"],
        update={
            "rolling_sd": F.col("new.rolling_sd"),
            "rolling_avg_volume": F.col("new.rolling_avg_volume"),
            "updated_at": F.col("new.updated_at"),
        },
    )
