"""One session: payloads to bars, flags, dead letters, baselines and a closed run.

The order matters. Flags are written before the prices; dead letters are cleared only for
symbols whose bar is in the price store; baselines are refreshed after the write, from it.
Each step writes a new version or replaces a slice, so the whole run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell import schemas
from closingbell.functions import recent_years
from closingbell.operators import failures, flags, gates, keyed, runs, stats, universe
from closingbell.sources import prices
from closingbell.sources.tables import Store

DAG_ID = "prices_daily"


COUNTS = ("flagged", "unvalidated", "unknown_bars", "duplicate_bars", "dlq_mismatch")


def run_daily(
    store: Store,
    landing: DataFrame,
    calendar: DataFrame,
    run_id: str,
    as_of,
    now,
    limits: flags.Limits = flags.Limits(),
) -> DataFrame:
    """Process one session's payloads; returns the run's log row and what it counted.

    ``COUNTS``: flagged bars, bars that no check could judge, bars of unknown symbols, bars that
    arrived more than once, and whether the queue disagrees with the missing writes. The tables'
    new versions count from the moment the run is closed.
    """
    spark = store.spark
    log = store.log_run(
        runs.first_state(spark, store.read("pipeline_run"), run_id, DAG_ID, as_of, now)
    )
    mine = F.col("id") == run_id
    work = store.begin()
    try:
        outcome = _ingest(work, landing, calendar, run_id, as_of, now, limits)
        outcome = work.keep(outcome, run_id, "outcome")
        log = store.log_run(runs.close_runs(log.filter(mine), outcome, now))
    except Exception as error:
        failed = _failure(spark, run_id, as_of, error)
        store.log_run(runs.fail_runs(log.filter(mine), failed, now))
        raise
    store.take_over(work)
    mismatch = runs.derive_status(outcome).select("id", "dlq_mismatch")
    return log.filter(mine).join(outcome.join(mismatch, "id").select("id", *COUNTS), "id")


def _failure(spark, run_id: str, as_of, error: Exception) -> DataFrame:
    return spark.createDataFrame(
        [(run_id, DAG_ID, str(as_of), str(error))],
        "id string, dag_id string, run_date string, error string",
    ).withColumn("run_date", F.col("run_date").cast("date"))


def _ingest(store, landing, calendar, run_id, as_of, now, limits) -> DataFrame:
    """Every count of a run is collected by the job that writes the rows it is about."""
    members = store.read("membership")
    listed = store.read("universe_membership")

    # payloads are parsed once; every step below reads the outcome
    gated, parsed = store.keep(
        gates.gate_payloads(landing, calendar), run_id, "gated", accepted=F.count_if(F.col("gate").isNull())
    )
    bars, batch = store.keep(
        gates.keep_last(gates.accepted_bars(gated), ["symbol", "date"], ["seq"]).drop("seq"),
        run_id,
        "bars",
        rows=F.count(F.lit(1)),
        first=F.min("date"),
        last=F.max("date"),
    )
    judged = write_flags(store, bars, (batch["first"], batch["last"]), members, run_id, now, limits)
    written = prices.upsert_prices(store.prices, bars)
    recorded = failures.record_failures(store.read("failed_ingestion"), gates.rejections(gated), members, now)
    _, queue = store.write(
        "failed_ingestion",
        failures.clear_resolved(recorded, bars, members),
        queued=F.count_if(F.col("created_at") >= schemas.clock(now)),
    )
    active, fetched = store.keep(
        universe.active_symbols(listed, members), run_id, "active", attempted=F.count(F.lit(1))
    )
    if written:
        refresh_baselines(store, bars, members, active, as_of, now)
    counts = {
        "written": written,
        # an empty list gives no honest count of what the run set out to fetch
        "attempted": fetched["attempted"] or None,
        "dlq_failures": queue["queued"],
        "duplicate_bars": parsed["accepted"] - batch["rows"],
        **judged,
    }
    return store.spark.range(1).select(
        F.lit(run_id).alias("id"),
        *(F.lit(value).cast("bigint").alias(name) for name, value in counts.items()),
    )


def write_flags(store: Store, bars, span, members, run_id, now, limits=flags.Limits()) -> dict[str, int]:
    """Replace the flags of the batch's sessions and symbols with the current evaluation.

    Every bar is judged by its own date, whenever the run is: the history is that of the batch's
    own years and the year before. ``span`` is the batch's first and last date; a batch is one
    session as a rule. The flags of the years it lies in are written anew: those it has no bar for
    come out as they were. Returns how many bars were flagged, how many no check could judge, and
    how many are of symbols without a membership.
    """
    first, last = span
    if first is None:
        return {"flagged": 0, "unvalidated": 0, "unknown_bars": 0}
    years = list(range(first.year, last.year + 1))
    history = store.prices.read([first.year - 1, *years])
    session = first if first == last else None
    ids = members.select(F.col("id").alias("symbol_id"), "symbol")
    tripped, counts = store.keep(
        flags.flag_bars(bars, history, limits, session=session).join(ids, "symbol", "left"),
        run_id,
        "judged",
        only=(F.size("rules") > 0) & F.col("symbol_id").isNotNull(),
        flagged=F.count_if(F.size("rules") > 0),
        unvalidated=F.count_if(F.col("checks_run") == 0),
        unknown_bars=F.count_if(F.col("symbol_id").isNull()),
    )
    evaluated = bars.select("symbol", F.col("date").alias("session_date")).join(ids, "symbol")
    rows = flags.known_flag_rows(tripped, run_id, now)
    stored = store.flags.read(years).drop("year")
    store.replace_flags(
        keyed.replace_slice(stored, evaluated, rows, schemas.UNIQUE_KEYS["ohlcv_flag"]), years
    )
    return counts


def refresh_baselines(store: Store, bars, members, active, as_of, now) -> None:
    """Rolling baselines of the active symbols, from the stored newest bars and the batch.

    The first run takes the newest bars from the price store, and so does a run for a year that
    is over: the newest bars of all are then not those it looks back on.
    """
    if store.whole["recent_bars"]:
        newest = stats.merge_recent(store.read("recent_bars"), bars)
    else:  # the price store holds the batch already
        stored = store.prices.read().select("symbol", "date", "close", "volume")
        newest = stats.newest_bars(stored, stats.WINDOW + 1)
    recent, reach = store.write("recent_bars", newest, newest=F.max("date"))
    years = recent_years(as_of)
    if reach["newest"].year > years[-1]:
        closes = stats.recent_closes(store.prices.read(), as_of, symbols=active)
    else:
        closes = recent.filter(F.year("date").isin(years)).join(active, "symbol", "left_semi")
    store.write(
        "volatility_rolling",
        failures.update_baselines(store.read("volatility_rolling"), stats.rolling_stats(closes), members, now),
    )


def backfill(store: Store, bars: DataFrame) -> int:
    """Bring in bars outside a run, and the newest of them into the state of the baselines."""
    written = prices.upsert_prices(store.prices, bars)
    if store.whole["recent_bars"]:
        store.write("recent_bars", stats.merge_recent(store.read("recent_bars"), bars))
    return written
