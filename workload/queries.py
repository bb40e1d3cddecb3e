"""One runnable query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closingbell.functions import recent_years
from closingbell.operators import audit, calendar, failures, flags, gates, keyed, maintenance
from closingbell.operators import runs as run_log
from closingbell.operators import stats, universe
from closingbell.operators.asof import asof_join
from closingbell.plans import daily, weekly
from closingbell.session import work_folder
from closingbell.sources import prices, tickers
from closingbell.sources.bucketed import save_bucketed
from closingbell.sources.payloads import FIELDS, parse_candles
from closingbell.sources.tables import Store
from closingbell.sources.years import CODEC
from workload.views import AS_OF, NOW, RUN_FROM, RUN_ID, Views

# The default volume multiple never trips on the given tables, so the flag queries pass a
# lower one; the defaults are covered by the tests' golden rows.
LIMITS = flags.Limits(volume_multiple=3.0)
TIGHT = flags.Limits(log_return_sigma=2.0, open_gap_sigma=1.5, volume_multiple=2.0)
SESSION = "2001-06-01"
REPLACED_FROM = "2000-01-01"
PAGE = 25


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _joined(column: str) -> Column:
    return F.array_join(column, ",")


ANNOTATED = [
    "symbol", "date", "rules", "prev_close", "log_return", "log_return_limit", "open_gap",
    "open_gap_limit", "volume", "volume_limit", "rolling_sd", "rolling_avg_volume", "checks_run",
]
DOUBLES = [
    "log_return", "log_return_limit", "open_gap", "open_gap_limit",
    "volume_limit", "rolling_sd", "rolling_avg_volume",
]


def _shown_flags(annotated: DataFrame) -> DataFrame:
    return _rounded(annotated.select(*ANNOTATED).withColumn("rules", _joined("rules")), *DOUBLES)


# -- bars and stats ------------------------------------------------------------------


def log_returns(v: Views) -> DataFrame:
    return _rounded(stats.log_returns(v.bars()), "log_return")


def recent_closes(v: Views) -> DataFrame:
    return stats.recent_closes(v.prices(), AS_OF)


def rolling_stats(v: Views) -> DataFrame:
    closes = stats.recent_closes(v.prices(), AS_OF)
    return _rounded(stats.rolling_stats(closes), "rolling_sd", "rolling_avg_volume")


def prev_close(v: Views) -> DataFrame:
    return stats.prev_close(v.prices(), SESSION)


def dedup_keep_last(v: Views) -> DataFrame:
    feed = v.ticks().select("key", "date", "price", "qty", "ord")
    return gates.keep_last(feed, ["key", "date"], ["ord"]).drop("ord")


def price_upsert(v: Views) -> DataFrame:
    return prices.merge_bars(v.bars(), v.corrections())


def _stored(v: Views, df: DataFrame, name: str) -> DataFrame:
    path = work_folder(v.spark, name)
    df.write.option("compression", CODEC).parquet(path)
    return v.spark.read.schema(df.schema).parquet(path)


def price_store(v: Views) -> DataFrame:
    """Bootstrap, merge twice (the second time changes nothing), read back."""
    table = prices.price_table(v.spark, work_folder(v.spark, "price-store"))
    prices.upsert_prices(table, v.bars())
    batch = _stored(v, v.corrections(), "corrections")
    prices.upsert_prices(table, batch)
    prices.upsert_prices(table, batch)
    return table.read()


def price_store_retry(v: Views) -> DataFrame:
    """A merge that failed before it counted, and the same merge again: it starts from the bars
    that counted before, whatever the first attempt has written."""
    root = work_folder(v.spark, "price-retry")
    table = prices.price_table(v.spark, root)
    prices.upsert_prices(table, v.bars())
    batch = _stored(v, v.corrections(), "corrections")
    prices.upsert_prices(table.copy(), batch)
    prices.upsert_prices(table, batch)
    return table.read()


def compact_prices(v: Views) -> DataFrame:
    """Two appended feeds leave small files; the repacked table reads the same."""
    table = prices.price_table(v.spark, work_folder(v.spark, "compaction"))
    prices.upsert_prices(table, v.bars())
    more = prices.with_year(v.event_bars())
    for year in [r.year for r in more.select("year").distinct().collect()]:
        add = table.append if year in table.versions else table.replace
        add(more.filter(F.col("year") == year), [year])
    maintenance.compact_prices(table)
    return table.read()


def orphan_files(v: Views) -> DataFrame:
    """Files of the versions that a merge leaves behind, as their years."""
    root = work_folder(v.spark, "orphans")
    table = prices.price_table(v.spark, root)
    prices.upsert_prices(table, v.bars())
    prices.upsert_prices(table, _stored(v, v.corrections(), "corrections"))
    later = maintenance.dt.datetime(2999, 1, 1)
    found = maintenance.orphan_files(v.spark, root, table.paths(), later)
    return found.select(
        F.regexp_extract("path", r"/v=(\d+)/", 1).cast("int").alias("version"),
        F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int").alias("year"),
    ).distinct()


def baseline_merge(v: Views) -> DataFrame:
    """Baselines from the stored newest bars and the late sessions' bars alone."""
    since = F.lit(RUN_FROM).cast("date")
    early = stats.newest_bars(v.bars().filter(F.col("date") < since), stats.WINDOW + 1)
    recent = _stored(v, early.select("symbol", "date", "close", "volume"), "recent-bars")
    merged = stats.merge_recent(recent, v.bars().filter(F.col("date") >= since))
    reached = merged.filter(F.year("date").isin(recent_years(AS_OF)))
    return _rounded(stats.rolling_stats(reached), "rolling_sd", "rolling_avg_volume")


def history_bucketed(v: Views) -> DataFrame:
    """The whole history annotated from a table in buckets by symbol."""
    name = f"bars_{v.spark.sparkContext.applicationId}_{abs(hash(v.sf_dir))}".replace("-", "_")
    table = save_bucketed(v.bars(), name, work_folder(v.spark, "bucketed"), 8)
    return _shown_flags(flags.flag_history(table, LIMITS))


def prices_of_symbols(v: Views) -> DataFrame:
    """Stored bars of the symbols that are listed in one small universe."""
    table = prices.price_table(v.spark, work_folder(v.spark, "listed-prices"))
    prices.upsert_prices(table, v.bars())
    stints = v.universe_membership().filter("universe_id = 'NATION_3'")
    return prices.of_symbols(table.read(), universe.active_symbols(stints, v.membership()))


def asof_close(v: Views) -> DataFrame:
    """Every order with the newest close of its customer's number, at most 30 days old."""
    orders = v.table("orders").select(
        "o_orderkey", F.concat(F.lit("T/"), F.col("o_custkey").cast("string")).alias("symbol"),
        F.to_date("o_orderdate").alias("date"),
    )
    closes = v.bars().select("symbol", "date", "close")
    return asof_join(orders, closes, ["symbol"], "date", tolerance=F.make_dt_interval(F.lit(30)))


# -- flags ---------------------------------------------------------------------------


def flag_bars(v: Views) -> DataFrame:
    """Every symbol's newest bar against the bars stored before it."""
    bars = v.bars()
    return _shown_flags(flags.flag_bars(stats.newest_bars(bars, 1), bars, TIGHT))


def flag_bars_stored(v: Views) -> DataFrame:
    """Every user's newest bar against the stored baselines of the listed symbols."""
    bars = v.event_bars()
    baseline = flags.stored_baselines(v.volatility(), v.membership())
    return _shown_flags(flags.flag_bars(stats.newest_bars(bars, 1), bars, TIGHT, baseline))


def flag_history(v: Views) -> DataFrame:
    return _shown_flags(flags.flag_history(v.bars(), LIMITS))


def flag_summary(v: Views) -> DataFrame:
    return flags.flag_summary(flags.flag_history(v.bars(), LIMITS))


def flag_replace(v: Views) -> DataFrame:
    """Flags of the sessions since 2000 replaced by an evaluation under tighter limits."""
    measured = stats.point_in_time(v.bars())
    members = v.membership()
    stored = flags.flag_rows(flags.annotate(measured, LIMITS), members, "earlier", NOW)
    again = measured.filter(F.col("date") >= F.lit(REPLACED_FROM).cast("date"))
    rows = flags.flag_rows(flags.annotate(again, TIGHT), members, RUN_ID, NOW)
    evaluated = universe.symbol_lookup(again.select("symbol", "date"), members).select(
        "symbol_id", F.col("date").alias("session_date")
    )
    replaced = keyed.replace_slice(stored, evaluated, rows, ["symbol_id", "session_date"])
    return _rounded(replaced.withColumn("rules", _joined("rules")), *DOUBLES)


def volatility_upsert(v: Views) -> DataFrame:
    after = failures.update_baselines(
        v.volatility(), stats.rolling_stats(v.event_bars()), v.membership(), NOW
    )
    return _rounded(after, "rolling_sd", "rolling_avg_volume")


# -- universes -----------------------------------------------------------------------


def _diff(v: Views) -> DataFrame:
    imported = universe.imported_symbols(v.tickers())
    active = universe.active_by_universe(v.universe_membership(), v.membership(), imported)
    return universe.universe_diff(imported, active)


def active_symbols(v: Views) -> DataFrame:
    return universe.active_symbols(v.universe_membership(), v.membership())


def active_by_universe(v: Views) -> DataFrame:
    imported = universe.imported_symbols(v.tickers())
    return universe.active_by_universe(v.universe_membership(), v.membership(), imported)


def symbol_lookup(v: Views) -> DataFrame:
    """Bars per known symbol id, and the unknown symbols the lookup leaves out."""
    bars, members = v.event_bars(), v.membership()
    known = universe.symbol_lookup(bars, members).groupBy("symbol", "symbol_id").agg(
        F.count("*").alias("rows")
    )
    unknown = universe.unknown_symbols(bars, members).select(
        "symbol", F.lit(None).cast("string").alias("symbol_id"), "rows"
    )
    return known.unionByName(unknown)


def universe_diff(v: Views) -> DataFrame:
    return _diff(v)


def universe_digest_diff(v: Views) -> DataFrame:
    imported = universe.imported_symbols(v.tickers())
    return universe.diff_by_digest(imported, v.universe_membership(), v.membership())


def membership_insert(v: Views) -> DataFrame:
    return universe.insert_memberships(v.membership(), _diff(v), NOW)


def relist_insert(v: Views) -> DataFrame:
    diff = _diff(v)
    members = universe.insert_memberships(v.membership(), diff, NOW)
    return universe.relist(v.universe_membership(), members, diff, AS_OF, NOW)


def close_membership(v: Views) -> DataFrame:
    return universe.close_memberships(
        v.universe_membership(), v.membership(), _diff(v), AS_OF, NOW
    )


def tickers_by_universe(v: Views) -> DataFrame:
    return universe.tickers_by_universe(v.tickers(), PAGE).withColumn(
        "members", _joined("members")
    )


def delisting_report(v: Views) -> DataFrame:
    report = universe.delisting_report(universe.imported_symbols(v.tickers()), _diff(v), PAGE)
    return report.withColumn("members", _joined("members"))


def scan_tickers(v: Views) -> DataFrame:
    """The snapshot written as CSV and scanned back."""
    path = work_folder(v.spark, "tickers")
    v.tickers().write.option("header", True).csv(path)
    return tickers.scan_tickers(v.spark, path)


def rejected_tickers(v: Views) -> DataFrame:
    """Lines of a snapshot that have a column too many: those of customers in debt."""
    path = work_folder(v.spark, "tickers-odd")
    debt = F.col("c_acctbal") < 0
    key = F.concat(F.lit("T."), F.col("c_custkey").cast("string"), F.lit(",SEA"))
    line = F.concat(key, F.when(debt, ",x,y").otherwise(""))
    # every file of a snapshot has its header
    v.table("customer").select(line.alias("ticker,universe")).write.option("header", True).option(
        "quoteAll", False
    ).option("quote", "\u0000").option("sep", "\u0001").csv(path)
    return tickers.rejected_lines(v.spark, path)


def symbol_batches(v: Views) -> DataFrame:
    active = universe.active_symbols(v.universe_membership(), v.membership())
    return universe.symbol_batches(active)


# -- ingestion -----------------------------------------------------------------------


def parse(v: Views) -> DataFrame:
    return parse_candles(v.landing()).select(
        "symbol", "seq", "status_code", "unreadable", "no_candles", "date", *FIELDS
    )


def _gate(name: str) -> Callable[[Views], DataFrame]:
    def run(v: Views) -> DataFrame:
        rejected = gates.rejections(gates.gate_payloads(v.landing(), v.calendar()))
        return rejected.filter(F.col("gate") == name).drop("gate")

    return run


def ingest_gate(v: Views) -> DataFrame:
    gated = gates.gate_payloads(v.landing(), v.calendar())
    return gated.select(
        "symbol", "seq", "date", *FIELDS, "gate", "failure", "failure_error"
    )


def prev_session(v: Views) -> DataFrame:
    asked = v.table("orders").select(F.to_date("o_orderdate").alias("as_of"))
    return calendar.with_previous_session(asked, "as_of", v.calendar()).groupBy(
        "as_of", "prev_session"
    ).agg(F.count("*").alias("orders"))


def union_chunks(v: Views) -> DataFrame:
    return gates.union_chunks([v.bars(), v.event_bars()])


# -- runs and dead letters -------------------------------------------------------------


def dlq_upsert(v: Views) -> DataFrame:
    rejected = gates.rejections(gates.gate_payloads(v.landing(), v.calendar()))
    return failures.record_failures(v.dlq(), rejected, v.membership(), NOW)


def dlq_clear(v: Views) -> DataFrame:
    return failures.clear_resolved(v.dlq(), v.bars(), v.membership())


def dlq_count_since(v: Views) -> DataFrame:
    return failures.count_since(v.dlq(), "1995-01-13 00:00:00")


def run_status(v: Views) -> DataFrame:
    """Every run closed, with the queue cross-check beside it."""
    outcomes = v.outcomes()
    checks = run_log.derive_status(outcomes).select("id", "dlq_mismatch")
    return run_log.close_runs(v.runs(), outcomes, NOW).join(checks, "id")


def run_failed(v: Views) -> DataFrame:
    return run_log.fail_runs(v.runs(), v.run_failures(), NOW)


def latest_runs(v: Views) -> DataFrame:
    return run_log.latest_runs(v.runs())


def daily_run(v: Views) -> DataFrame:
    """A whole run over the landed payloads; the price store as it leaves it."""
    store = _listed_store(v, "daily")
    daily.run_daily(store, _stored(v, v.landing(), "landing"), v.calendar(), RUN_ID, AS_OF, NOW)
    return store.prices.read()


def weekly_run(v: Views) -> DataFrame:
    """A snapshot applied to the stored universes; the membership history it leaves."""
    return _weekly(v).read("universe_membership")


def weekly_membership(v: Views) -> DataFrame:
    return _weekly(v).read("membership")


def _weekly(v: Views) -> Store:
    store = _listed_store(v, "weekly")
    snapshot = work_folder(v.spark, "snapshot")
    v.tickers().write.option("header", True).csv(snapshot)
    weekly.run_weekly(store, snapshot, RUN_ID, AS_OF, NOW)
    return store


def _after_run(v: Views) -> tuple[Store, DataFrame]:
    """A store that holds history, failures and baselines, after a run over the late sessions."""
    store = _listed_store(v, "after-run")
    store.write("volatility_rolling", v.volatility())
    store.write("failed_ingestion", v.dlq())
    daily.backfill(store, v.history())
    landing = _stored(v, v.late_landing(), "late-landing")
    report = daily.run_daily(store, landing, v.calendar(), RUN_ID, AS_OF, NOW, TIGHT)
    return store, report


def daily_flags(v: Views) -> DataFrame:
    stored = _after_run(v)[0].read("ohlcv_flag")
    return _rounded(stored.withColumn("rules", _joined("rules")), *DOUBLES)


def daily_dlq(v: Views) -> DataFrame:
    return _after_run(v)[0].read("failed_ingestion")


def daily_baselines(v: Views) -> DataFrame:
    return _rounded(
        _after_run(v)[0].read("volatility_rolling"), "rolling_sd", "rolling_avg_volume"
    )


def daily_log(v: Views) -> DataFrame:
    return _after_run(v)[0].read("pipeline_run")


def daily_report(v: Views) -> DataFrame:
    return _after_run(v)[1].select("id", *daily.COUNTS)


def failure_list(v: Views) -> DataFrame:
    """Failures that somebody has to look at, the most tried first."""
    return _after_run(v)[0].sql(
        "SELECT raw_symbol, failure, attempts FROM failed_ingestion"
        " WHERE review_required AND attempts >= :least ORDER BY attempts DESC, raw_symbol",
        least=3,
    )


def sql_prices(v: Views) -> DataFrame:
    """A query by name over the stored prices, with a bound parameter."""
    return _after_run(v)[0].sql(
        "SELECT symbol, count(*) AS bars, max(close) AS top FROM prices"
        " WHERE date >= :since GROUP BY symbol",
        since="2001-01-01",
    )


def run_start(v: Views) -> DataFrame:
    return run_log.start_run(v.spark, v.runs(), RUN_ID, daily.DAG_ID, AS_OF, NOW)


def keyed_upsert(v: Views) -> DataFrame:
    """On a stored bar only the close changes, and volumes add up."""
    update = {"close": F.col("new.close"), "volume": F.col("old.volume") + F.col("new.volume")}
    return keyed.upsert(v.bars(), v.corrections(), ["symbol", "date"], update)


def merge_refused(v: Views) -> DataFrame:
    """Keys for which ticks are no source of a merge into bars."""
    return keyed.duplicate_keys(v.ticks(), ["key", "date"])


def _listed_store(v: Views, name: str) -> Store:
    store = Store(v.spark, work_folder(v.spark, name))
    store.write("universe", v.universe())
    store.write("membership", v.membership())
    store.write("universe_membership", v.universe_membership())
    return store


# -- audits and upkeep -----------------------------------------------------------------


def audit_unique(v: Views) -> DataFrame:
    return audit.audit_unique(v.table("lineitem"), ["l_orderkey", "l_linenumber"])


def audit_active_unique(v: Views) -> DataFrame:
    stints = v.table("orders").select(
        F.col("o_custkey").alias("membership_id"),
        F.col("o_orderpriority").alias("universe_id"),
        F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("exit_date"),
    )
    return audit.audit_unique(stints, ["membership_id", "universe_id"], "exit_date IS NULL")


def audit_values(v: Views) -> DataFrame:
    return audit.audit_values(v.table("orders"), "o_orderstatus", ["F", "O"])


def audit_fk(v: Views) -> DataFrame:
    return audit.audit_fk(v.table("events"), "user_id", v.table("supplier"), "s_suppkey")


def audit_required(v: Views) -> DataFrame:
    """Orders without a line, and priorities longer than eight characters."""
    # an order of very many lines must not crowd the join: its lines count once
    lines = v.table("lineitem").select("l_orderkey").distinct()
    placed = v.table("orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return audit.audit_required(
        placed, ["o_orderkey"], ["l_orderkey"], {"o_orderpriority": 8}
    )


def retention_purge(v: Views) -> DataFrame:
    kept = maintenance.retention_purge(v.table("events"), "ts", "2024-02-15")
    return kept.select("event_id", "ts")


QUERIES: dict[str, Callable[[Views], DataFrame]] = {
    "log_returns": log_returns,
    "recent_closes": recent_closes,
    "rolling_stats": rolling_stats,
    "prev_close": prev_close,
    "dedup_keep_last": dedup_keep_last,
    "price_upsert": price_upsert,
    "baseline_merge": baseline_merge,
    "history_bucketed": history_bucketed,
    "prices_of_symbols": prices_of_symbols,
    "asof_close": asof_close,
    "universe_digest_diff": universe_digest_diff,
    "rejected_tickers": rejected_tickers,
    "price_store": price_store,
    "flag_bars": flag_bars,
    "flag_bars_stored": flag_bars_stored,
    "flag_history": flag_history,
    "flag_summary": flag_summary,
    "flag_replace": flag_replace,
    "volatility_upsert": volatility_upsert,
    "active_symbols": active_symbols,
    "active_by_universe": active_by_universe,
    "symbol_lookup": symbol_lookup,
    "universe_diff": universe_diff,
    "membership_insert": membership_insert,
    "relist_insert": relist_insert,
    "close_membership": close_membership,
    "tickers_by_universe": tickers_by_universe,
    "delisting_report": delisting_report,
    "scan_tickers": scan_tickers,
    "symbol_batches": symbol_batches,
    "parse_candles": parse,
    "gate_http": _gate("http"),
    "gate_session_date": _gate("session_date"),
    "gate_positive": _gate("positive"),
    "gate_ohlc": _gate("ohlc"),
    "ingest_gate": ingest_gate,
    "prev_session": prev_session,
    "union_chunks": union_chunks,
    "dlq_upsert": dlq_upsert,
    "dlq_clear": dlq_clear,
    "dlq_count_since": dlq_count_since,
    "run_status": run_status,
    "run_failed": run_failed,
    "latest_runs": latest_runs,
    "daily_run": daily_run,
    "weekly_run": weekly_run,
    "weekly_membership": weekly_membership,
    "daily_flags": daily_flags,
    "daily_dlq": daily_dlq,
    "daily_baselines": daily_baselines,
    "daily_log": daily_log,
    "daily_report": daily_report,
    "failure_list": failure_list,
    "sql_prices": sql_prices,
    "run_start": run_start,
    "keyed_upsert": keyed_upsert,
    "merge_refused": merge_refused,
    "price_store_retry": price_store_retry,
    "audit_unique": audit_unique,
    "audit_active_unique": audit_active_unique,
    "audit_values": audit_values,
    "audit_fk": audit_fk,
    "audit_required": audit_required,
    "retention_purge": retention_purge,
    "compact_prices": compact_prices,
    "orphan_files": orphan_files,
}


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Views(spark, sf_dir))

    return {name: bind(query) for name, query in QUERIES.items()}
