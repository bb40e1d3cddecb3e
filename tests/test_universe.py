import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import data
from closingbell import schemas
from closingbell.functions import normalise_symbol
from closingbell.operators import audit, positions, universe
from closingbell.sources import tickers
from plan_text import plan_of

OPEN, LEFT = dt.date(2020, 1, 1), dt.date(2021, 1, 1)


def snapshot(spark, pairs):
    return spark.createDataFrame(pairs, schemas.TICKERS)


def apply(spark, history, members, pairs, as_of="2024-01-07"):
    imported = universe.imported_symbols(snapshot(spark, pairs))
    diff = universe.universe_diff(imported, universe.active_by_universe(history, members, imported))
    members = universe.insert_memberships(members, diff, data.NOW)
    opened = universe.relist(history, members, diff, as_of, data.NOW)
    return universe.close_memberships(opened, members, diff, as_of, data.NOW), members, diff


def active(history, members):
    rows = universe.active_memberships(history).join(
        members.select(F.col("id").alias("membership_id"), "symbol"), "membership_id"
    )
    return sorted((r.universe_id, r.symbol) for r in rows.collect())


@pytest.mark.parametrize(
    "ticker, symbol",
    [("BRK.B", "BRK/B"), ("BRK-B", "BRK/B"), ("a b", "a b"), ("A B", "A B"), (" A*", " A/"),
     ("éX", "/X"), ("A\x1cB", "A\x1cB"), ("\U0001f600", "/"), ("", "")],
)
def test_normalise(spark, ticker, symbol):
    frame = spark.createDataFrame([(ticker,)], "t string")
    assert frame.select(normalise_symbol(F.col("t")).alias("s")).first().s == symbol


def test_diff_per_imported_universe(spark):
    members = data.membership(spark, "BRK/B", "OLD", "KEEP")
    history = data.stints(spark, [("OLD", "u1", OPEN, None), ("KEEP", "u1", OPEN, None), ("OLD", "u2", OPEN, None)])
    after, members, diff = apply(
        spark, history, members, [("BRK.B", "u1"), ("BRK-B", "u1"), ("KEEP", "u1"), ("KEEP", "u1")]
    )
    assert sorted((r.universe, r.symbol, r.change) for r in diff.collect()) == [
        ("u1", "BRK/B", "new"), ("u1", "OLD", "delisted")
    ]
    assert active(after, members) == [("u1", "BRK/B"), ("u1", "KEEP"), ("u2", "OLD")]
    closed = after.filter("exit_date IS NOT NULL").first()
    assert closed.exit_date == dt.date(2024, 1, 7) and closed.updated_at == dt.datetime(2024, 1, 3, 6, 30)


def test_relisting_keeps_the_closed_row(spark):
    members = data.membership(spark, "A")
    history = data.stints(spark, [("A", "u1", OPEN, LEFT)])
    after, _, _ = apply(spark, history, members, [("A", "u1")])
    assert sorted((r.enter_date, r.exit_date) for r in after.collect() if r.exit_date) == [(OPEN, LEFT)]
    assert [r.enter_date for r in after.collect() if r.exit_date is None] == [dt.date(2024, 1, 7)]


def test_empty_snapshot_changes_nothing(spark):
    members = data.membership(spark, "A")
    history = data.stints(spark, [("A", "u1", OPEN, None)])
    after, _, diff = apply(spark, history, members, [])
    assert diff.count() == 0 and after.collect() == history.collect()


def test_known_member_is_not_inserted_again(spark):
    members = data.membership(spark, "A")
    diff = spark.createDataFrame([("u1", "A", "new"), ("u2", "N", "new"), ("u3", "N", "new")],
                                 "universe string, symbol string, change string")
    rows = {r.symbol: r for r in universe.insert_memberships(members, diff, data.NOW).collect()}
    assert len(rows) == 2 and rows["A"].id == "id-A"
    assert rows["N"].created_at == dt.datetime(2024, 1, 3, 6, 30)


pairs = st.lists(st.tuples(st.sampled_from(["A", "B.", "B-", "C", "D"]), st.sampled_from(["u1", "u2"])), max_size=6)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=pairs, second=pairs)
def test_applying_a_diff_makes_active_equal_import(spark, first, second):
    history, members = data.empty(spark, "universe_membership"), data.empty(spark, "membership")
    history, members, _ = apply(spark, history, members, first, "2024-01-07")
    history = spark.createDataFrame(history.collect(), schemas.UNIVERSE_MEMBERSHIP)
    members = spark.createDataFrame(members.collect(), schemas.MEMBERSHIP)
    history, members, _ = apply(spark, history, members, second, "2024-01-14")
    covered = {u for _, u in second}
    wanted = {(u, t.replace(".", "/").replace("-", "/")) for t, u in second}
    kept = {(u, t.replace(".", "/").replace("-", "/")) for t, u in first if u not in covered}
    assert active(history, members) == sorted(wanted | kept)
    assert audit.audit_unique(history, ["membership_id", "universe_id"], "exit_date IS NULL").count() == 0


def test_active_symbols_are_distinct(spark):
    members = data.membership(spark, "A", "B", "C")
    history = data.stints(spark, [("A", "u1", OPEN, None), ("A", "u2", OPEN, None), ("B", "u1", OPEN, LEFT)])
    assert [r.symbol for r in universe.active_symbols(history, members).collect()] == ["A"]


def test_lookup_and_unknown(spark):
    members = data.membership(spark, "A")
    rows = spark.createDataFrame([("A",), ("X",), ("X",)], "symbol string")
    assert [r.symbol_id for r in universe.symbol_lookup(rows, members).collect()] == ["id-A"]
    assert [tuple(r) for r in universe.unknown_symbols(rows, members).collect()] == [("X", 2)]


def test_batches_are_full_and_complete(spark):
    symbols = spark.range(1050).selectExpr("concat('S', id) AS symbol")
    batches = universe.symbol_batches(symbols, 100, digits=2)
    sizes = [r["count"] for r in batches.groupBy("batch_id").count().orderBy("batch_id").collect()]
    assert sizes == [100] * 10 + [50] and batches.select("symbol").distinct().count() == 1050


def test_no_window_over_a_whole_group(spark):
    frame = spark.range(100).selectExpr("'u' AS universe", "concat('S', id) AS ticker")
    numbered = positions.number_rows(frame, ["universe"], "ticker")
    rows = numbered.orderBy("position").collect()
    assert [r.position for r in rows] == list(range(100)) and {r.group_size for r in rows} == {100}
    plan = plan_of(numbered)
    ranked = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert ranked and all("__bucket" in line for line in ranked)


def test_pages_hold_the_whole_group(spark):
    frame = spark.range(57).selectExpr("'u' AS universe", "concat('S', id) AS ticker")
    pages = universe.tickers_by_universe(frame.union(frame), page_size=10).collect()
    assert sorted(len(p.members) for p in pages) == [7, 10, 10, 10, 10, 10]
    assert {t for p in pages for t in p.members} == {f"S{i}" for i in range(57)}
    assert {p.group_size for p in pages} == {57}


def test_report_has_quiet_universes(spark):
    imported = spark.createDataFrame([("u1", "A"), ("u2", "B")], "universe string, symbol string")
    diff = spark.createDataFrame([("u1", "X", "delisted"), ("u1", "Y", "delisted"), ("u2", "B", "new")],
                                 "universe string, symbol string, change string")
    report = {r.universe: (r.delisted, r.members) for r in universe.delisting_report(imported, diff).collect()}
    assert report == {"u1": (2, ["X", "Y"]), "u2": (0, [])}


def test_scan_by_header_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text('universe,note,ticker\nu1,x,NVDA\nu1,,\nu2,"a,b",BRK.B')
    rows = tickers.scan_tickers(spark, str(tmp_path / "t.csv")).collect()
    assert [tuple(r) for r in rows] == [("NVDA", "u1"), ("", "u1"), ("BRK.B", "u2")]


def test_scan_failures_are_distinct(spark, tmp_path):
    with pytest.raises(tickers.TickersMissing):
        tickers.scan_tickers(spark, str(tmp_path / "none.csv"))
    (tmp_path / "odd.csv").write_text("symbol,universe\nA,u1\n")
    with pytest.raises(ValueError, match="ticker"):
        tickers.scan_tickers(spark, str(tmp_path / "odd.csv"))
    (tmp_path / "bad.csv").write_text("ticker,universe\nA,u1,extra\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tickers.scan_tickers(spark, str(tmp_path / "bad.csv")).collect()
