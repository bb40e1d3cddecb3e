"""Run log: start, status from the run's own numbers, failure notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from closingbell import schemas


# The stored log: a row for each state a run went through, numbered per run.
ENTRIES = StructType([*schemas.TABLES["pipeline_run"].fields, StructField("entry", LongType())])


def numbered(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """New states of some runs as log entries, numbered after those that the log has."""
    known = entries.groupBy("id").agg(F.max("entry").alias("__last"))
    return rows.join(known, "id", "left").select(
        *schemas.TABLES["pipeline_run"].names, (F.coalesce("__last", F.lit(0)) + 1).alias("entry")
    )


def current(entries: DataFrame) -> DataFrame:
    """The run log: each run as its last entry says."""
    newest = entries.groupBy("id").agg(F.max("entry").alias("entry"))
    return entries.join(newest, ["id", "entry"], "left_semi").select(*schemas.TABLES["pipeline_run"].names)


def new_run(spark: SparkSession, run_id: str, dag_id: str, run_date, now) -> DataFrame:
    """The first state of a run."""
    row = spark.range(1).select(
        F.lit(run_id).alias("id"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(str(run_date)).cast("date").alias("run_date"),
        F.lit("RUNNING").alias("status"),
    )
    return schemas.conform(row, "pipeline_run", now)


def first_state(
    spark: SparkSession, runs: DataFrame, run_id: str, dag_id: str, run_date, now
) -> DataFrame:
    """``new_run`` for a run that the log doesn't know, else no row."""
    known = runs.filter(F.col("id") == run_id).withColumn("__known", F.lit(True))
    new = new_run(spark, run_id, dag_id, run_date, now).withColumn("__known", F.lit(False))
    either = known.unionByName(new).orderBy(F.desc("__known")).limit(1)
    return either.filter(~F.col("__known")).drop("__known")


def start_run(
    spark: SparkSession, runs: DataFrame, run_id: str, dag_id: str, run_date, now
) -> DataFrame:
    """The log with a run that it may know already: a known one stays as it is."""
    return runs.unionByName(first_state(spark, runs, run_id, dag_id, run_date, now))


def derive_status(outcomes: DataFrame) -> DataFrame:
    """Status of ``(id, written, attempted, dlq_failures)``; ``attempted`` may be unknown.

    The queue count is a cross-check: where it disagrees with the missing writes,
    ``dlq_mismatch`` says so, and the status still follows the run's own numbers.
    """
    written, attempted, queued = (
        F.col(name) for name in ("written", "attempted", "dlq_failures")
    )
    lost = F.greatest(attempted - written, F.lit(0))
    status = (
        F.when(written == 0, "FAILED")
        .when(attempted.isNull(), F.when(queued == 0, "SUCCESS").otherwise("PARTIAL"))
        .when((written < attempted) | (queued > 0), "PARTIAL")
        .otherwise("SUCCESS")
    )
    return outcomes.select(
        "id",
        status.alias("status"),
        written.cast("int").alias("records_processed"),
        F.when(attempted.isNull(), queued).otherwise(lost).cast("int").alias("records_failed"),
        (attempted.isNotNull() & (lost != queued)).alias("dlq_mismatch"),
    )


def close_runs(runs: DataFrame, outcomes: DataFrame, now) -> DataFrame:
    """The run log with the given runs closed; an unknown run id adds nothing."""
    return _set_known(
        runs,
        derive_status(outcomes),
        {
            "status": F.col("new.status"),
            "completed_at": schemas.clock(now),
            "records_processed": F.col("new.records_processed"),
            "records_failed": F.col("new.records_failed"),
        },
    )


def succeed_run(runs: DataFrame, run_id: str, now) -> DataFrame:
    """Plain SUCCESS, for the run that maintains the universes."""
    return _where_id(runs, run_id, {"status": F.lit("SUCCESS"), "completed_at": schemas.clock(now)})


def _where_id(runs: DataFrame, run_id: str, update: dict[str, Column]) -> DataFrame:
    return runs.select(
        *[
            F.when(F.col("id") == run_id, update[name]).otherwise(F.col(name)).alias(name)
            if name in update
            else F.col(name)
            for name in runs.columns
        ]
    )


def _set_known(runs: DataFrame, changes: DataFrame, update: dict[str, Column]) -> DataFrame:
    old = runs.alias("old")
    new = changes.withColumn("__hit", F.lit(True)).alias("new")
    hit = F.coalesce(F.col("new.__hit"), F.lit(False))
    return old.join(new, F.col("old.id") == F.col("new.id"), "left").select(
        *[
            (F.when(hit, update[name]).otherwise(F.col(f"old.{name}")) if name in update
             else F.col(f"old.{name}"))
            .cast(runs.schema[name].dataType)
            .alias(name)
            for name in runs.columns
        ]
    )


def fail_runs(runs: DataFrame, failures: DataFrame, now) -> DataFrame:
    """Mark runs FAILED with the error in ``notes``.

    ``failures`` is ``(id, dag_id, run_date, error)``. Without an id the run is the latest
    started one of that dag and date; a failure that matches no run changes nothing. Several
    errors of one run leave the greatest as its note, so the result does not depend on order.
    """
    # fold first: runs per (dag, date) and errors per run may be many
    latest = runs.groupBy("dag_id", "run_date").agg(
        F.max_by("id", F.struct("started_at", "id")).alias("latest_id")
    )
    unnamed = (
        failures.filter(F.col("id").isNull())
        .groupBy("dag_id", "run_date")
        .agg(F.max("error").alias("error"))
        .join(latest, ["dag_id", "run_date"])
        .select(F.col("latest_id").alias("id"), "error")
    )
    named = failures.filter(F.col("id").isNotNull()).select("id", "error")
    notes = named.unionByName(unnamed).groupBy("id").agg(F.max("error").alias("error"))
    return _set_known(
        runs,
        notes,
        {
            "status": F.lit("FAILED"),
            "completed_at": schemas.clock(now),
            "notes": F.col("new.error"),
        },
    )


def latest_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The newest runs; a top-n on every task and a merge of n rows each, no global sort."""
    return runs.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(n)
