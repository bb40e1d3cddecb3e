import datetime as dt

import pytest

import data
from closingbell import schemas
from closingbell.operators import maintenance
from closingbell.plans import daily, upkeep, weekly
from closingbell.sources import tables

FIRST = dt.date(2024, 1, 1)


def session(i):
    return FIRST + dt.timedelta(days=i)


def payloads(spark, i, close, broken=()):
    rows, at = [], dt.datetime.combine(session(i + 1), dt.time(6, 30))
    for seq, symbol in enumerate(["A", "B", "C"]):
        price = close if symbol == "A" else 50 + (i % 2)
        text = data.body(data.candle(session(i), open=price, high=price, low=price, close=price))
        rows.append((symbol, 500 if symbol in broken else 200, text, seq, at))
    return spark.createDataFrame(rows, schemas.LANDING)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    (root / "tickers.csv").write_text("ticker,universe\nA,u1\nB,u1\nC,u1\nGONE,u1\n")
    made = tables.Store(spark, str(root / "db"))
    made.write("universe", spark.createDataFrame([("u1", "u1", None, None)], schemas.UNIVERSE))
    weekly.run_weekly(made, str(root / "tickers.csv"), "w1", "2023-12-31", "2023-12-31 00:00:00")
    (root / "tickers.csv").write_text("ticker,universe\nA,u1\nB,u1\nC,u1\n")
    report = weekly.run_weekly(made, str(root / "tickers.csv"), "w2", "2023-12-31", "2023-12-31 01:00:00")
    assert [(r.universe, r.delisted, r.members) for r in report.collect()] == [("u1", 1, ["GONE"])]
    # 22 sessions of history without the daily runs
    history = [
        (symbol, session(i), p, p, p, p, 500)
        for i in range(22) for symbol in "ABC"
        for p in [float(100 + i % 2) if symbol == "A" else float(50 + i % 2)]
    ]
    daily.backfill(made, spark.createDataFrame(history, schemas.BAR))
    return made


def run(store, i, close, broken=(), run_id=None):
    calendar = store.spark.createDataFrame([(session(k),) for k in range(60)], schemas.CALENDAR)
    at = session(i + 1)
    return daily.run_daily(
        store, payloads(store.spark, i, close, broken), calendar, run_id or f"d{i}", at, f"{at} 06:30:00"
    ).first()


def flags(store):
    return {(r.symbol_id, r.session_date): r.rules for r in store.read("ohlcv_flag").collect()}


def test_sessions_end_to_end(store):
    spark = store.spark
    ids = {r.symbol: r.id for r in store.read("membership").collect()}

    row = run(store, 22, 100, broken={"B"})
    assert (row.status, row.records_processed, row.records_failed) == ("PARTIAL", 2, 1)
    failed = store.read("failed_ingestion").collect()
    assert [(r.symbol_id, r.attempts, r.failure) for r in failed] == [(ids["B"], 1, "HTTP_ERROR")]
    assert flags(store) == {}
    assert {r.symbol_id for r in store.read("volatility_rolling").collect()} == {ids[s] for s in "ABC"}

    row = run(store, 23, 150)
    assert (row.status, row.records_processed, row.records_failed) == ("SUCCESS", 3, 0)
    assert store.read("failed_ingestion").count() == 0
    # the open jumped with the close
    assert flags(store) == {(ids["A"], session(23)): ["log_return", "open_gap"]}

    # the same session again, corrected: bars replaced, the stale flag removed
    row = run(store, 23, 100, run_id="d23-again")
    assert row.status == "SUCCESS" and flags(store) == {}
    table = store.prices.read()
    assert table.count() == 22 * 3 + 2 + 3
    assert table.filter(f"date = '{session(23)}' AND symbol = 'A'").first().close == 100.0

    log = {r.id: r.status for r in store.read("pipeline_run").collect()}
    assert log == {"w1": "SUCCESS", "w2": "SUCCESS", "d22": "PARTIAL", "d23": "SUCCESS", "d23-again": "SUCCESS"}


def test_monitoring_queries(store):
    newest = store.sql("SELECT id FROM pipeline_run ORDER BY started_at DESC, id DESC LIMIT 2")
    assert [r.id for r in newest.collect()] == ["d23-again", "d23"]
    one = store.sql("SELECT close FROM prices WHERE symbol = :symbol AND date = :day", symbol="A", day=session(22))
    assert [r.close for r in one.collect()] == [100.0]
    assert store.sql("SELECT * FROM failed_ingestion").count() == 0
    assert store.sql("SELECT * FROM ohlcv_flag").count() == 0


def test_failed_run_is_logged(store, monkeypatch):
    monkeypatch.setattr(daily.prices, "upsert_prices", lambda *a: (_ for _ in ()).throw(OSError("disk gone")))
    with pytest.raises(OSError):
        run(store, 24, 100)
    row = {r.id: r for r in store.read("pipeline_run").collect()}["d24"]
    assert (row.status, row.notes) == ("FAILED", "disk gone")


def test_upkeep_removes_only_left_overs(store):
    spark = store.spark
    before = sorted(tuple(r) for r in store.prices.read().collect())
    tables_before = {name: store.read(name).count() for name in schemas.TABLES}
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=200)
    packed, found = upkeep.run_upkeep(store, "upkeep", later, dry_run=False)
    assert {r.year: r.files_after for r in packed.collect()} == {2024: 1}
    assert found.count() > 0
    left = maintenance.orphan_files(spark, store.root, store.live_paths(), later)
    assert {r.path.split("/work/")[-1].split("/")[1] for r in left.collect()} <= {"orphans"}
    assert sorted(tuple(r) for r in store.prices.read().collect()) == before
    assert {name: store.read(name).count() for name in schemas.TABLES} == tables_before


def test_missing_snapshot_fails_the_run(store):
    with pytest.raises(FileNotFoundError):
        weekly.run_weekly(store, "/nowhere/tickers.csv", "w9", "2024-02-01", "2024-02-01 00:00:00")
    assert {r.id: r.status for r in store.read("pipeline_run").collect()}["w9"] == "FAILED"


def test_a_run_that_failed_twice_counts_its_failures_once(store, monkeypatch):
    """Versions are taken over only when a run closes."""
    versions = dict(store.versions)
    ids = {r.symbol: r.id for r in store.read("membership").collect()}
    whole = daily.prices.upsert_prices
    for _ in range(2):
        monkeypatch.setattr(daily.prices, "upsert_prices", lambda *a: (_ for _ in ()).throw(OSError("disk gone")))
        with pytest.raises(OSError):
            run(store, 30, 100, broken={"C"}, run_id="retried")
        assert store.versions == versions
    monkeypatch.setattr(daily.prices, "upsert_prices", whole)
    row = run(store, 30, 100, broken={"C"}, run_id="retried")
    assert row.status == "PARTIAL"
    failed = store.read("failed_ingestion").filter(f"symbol_id = '{ids['C']}'").collect()
    assert [r.attempts for r in failed] == [1]
    assert {r.id: r.status for r in store.read("pipeline_run").collect()}["retried"] == "PARTIAL"


def test_a_late_run_leaves_the_same_flags(store):
    """A bar is judged by its own date, not by the run's."""
    row = run(store, 31, 170)
    assert row.flagged == 1 and row.unvalidated == 0 and row.unknown_bars == 0
    first = flags(store)
    assert any(day == session(31) for _, day in first)
    calendar = store.spark.createDataFrame([(session(k),) for k in range(60)], schemas.CALENDAR)
    daily.run_daily(store, payloads(store.spark, 31, 170), calendar, "late", "2027-05-01", "2027-05-01 06:30:00")
    assert flags(store) == first


def test_a_run_reports_what_it_counted(store):
    spark = store.spark
    twice = payloads(spark, 32, 100)
    extra = spark.createDataFrame([("X", 200, r.body, 9, r.fetched_at) for r in twice.limit(1).collect()], schemas.LANDING)
    calendar = spark.createDataFrame([(session(k),) for k in range(60)], schemas.CALENDAR)
    again = twice.selectExpr("symbol", "status_code", "body", "seq + 10 AS seq", "fetched_at")
    row = daily.run_daily(
        store, twice.union(again).union(extra), calendar, "counted", session(33), f"{session(33)} 06:30:00"
    ).first()
    assert (row.duplicate_bars, row.unknown_bars, row.records_processed) == (3, 1, 4)
    assert row.dlq_mismatch is False
