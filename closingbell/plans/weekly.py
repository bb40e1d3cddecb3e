"""Universe maintenance: a ticker snapshot against the membership history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell.operators import runs, universe
from closingbell.sources.tables import Store
from closingbell.sources.tickers import scan_tickers

DAG_ID = "universe_weekly"


def run_weekly(store: Store, snapshot: str, run_id: str, as_of, now) -> DataFrame:
    """Apply a snapshot; returns the delisting report.

    New symbols get a membership and an open row, symbols missing from a universe that the
    snapshot covers are closed, universes it does not cover stay as they are.
    """
    spark = store.spark
    log = store.log_run(
        runs.first_state(spark, store.read("pipeline_run"), run_id, DAG_ID, as_of, now)
    )
    mine = F.col("id") == run_id
    work = store.begin()
    try:
        imported = work.keep(
            universe.imported_symbols(scan_tickers(spark, snapshot)), run_id, "imported"
        )
        members = work.read("membership")
        history = work.read("universe_membership")
        diff = work.keep(universe.diff_by_digest(imported, history, members), run_id, "diff")

        members = work.write("membership", universe.insert_memberships(members, diff, now))
        opened = universe.relist(history, members, diff, as_of, now)
        work.write(
            "universe_membership",
            universe.close_memberships(opened, members, diff, as_of, now),
        )
        store.log_run(runs.succeed_run(log.filter(mine), run_id, now))
    except Exception as error:
        failed = spark.range(1).select(
            F.lit(run_id).alias("id"),
            F.lit(DAG_ID).alias("dag_id"),
            F.lit(str(as_of)).cast("date").alias("run_date"),
            F.lit(str(error)).alias("error"),
        )
        store.log_run(runs.fail_runs(log.filter(mine), failed, now))
        raise
    store.take_over(work)
    return universe.delisting_report(imported, diff)
