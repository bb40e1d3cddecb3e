"""A third of all rows under one key: results stay whole and exact."""

import pytest
from pyspark.sql import functions as F

import data
from closingbell.operators import audit, failures, gates, universe
from plan_text import plan_of

ROWS = 30_000
HOT = ROWS // 3


@pytest.fixture(scope="module")
def feed(spark):
    """Key 0 holds a third of the rows, the others are spread over 1,000 keys."""
    key = F.when(F.col("id") < HOT, 0).otherwise(1 + F.col("id") % 1000)
    return spark.range(ROWS).select(
        F.concat(F.lit("S"), key).alias("symbol"), F.col("id").alias("seq")
    )


def brute(feed):
    last, count = {}, {}
    for row in feed.collect():
        last[row.symbol] = max(last.get(row.symbol, -1), row.seq)
        count[row.symbol] = count.get(row.symbol, 0) + 1
    return last, count


def partial_before_shuffle(df, node: str) -> bool:
    plan = plan_of(df)
    return plan.rindex(node) > plan.rindex("Exchange hashpartitioning")


def test_keep_last(feed):
    kept = gates.keep_last(feed, ["symbol"], ["seq"])
    assert {r.symbol: r.seq for r in kept.collect()} == brute(feed)[0]
    assert partial_before_shuffle(kept, "WindowGroupLimit")


def test_failures(spark, feed):
    last, count = brute(feed)
    members = feed.select(F.concat(F.lit("id-"), "symbol").alias("id"), "symbol").distinct()
    failing = feed.select("symbol", "seq", F.lit("VALIDATION").alias("failure"),
                          F.col("seq").cast("string").alias("failure_error"))
    queue = failures.record_failures(data.empty(spark, "failed_ingestion"), failing, members, data.NOW)
    found = {r.raw_symbol: (r.attempts, int(r.failure_error)) for r in queue.collect()}
    assert found == {s: (count[s], last[s]) for s in count}
    folded = failing.groupBy("symbol").agg(F.count("*"))
    assert partial_before_shuffle(folded, "partial_count")


def test_one_universe_with_most_tickers(spark, feed):
    tickers = feed.select(
        F.concat(F.lit("T"), F.col("seq") % 20_000).alias("ticker"),
        F.when(F.col("seq") < HOT, "big").otherwise(F.concat(F.lit("u"), F.col("seq") % 7)).alias("universe"),
    )
    expected = {}
    for row in tickers.collect():
        expected.setdefault(row.universe, set()).add(row.ticker)
    pages = universe.tickers_by_universe(tickers, page_size=500).collect()
    found = {}
    for page in pages:
        assert len(page.members) <= 500 and page.group_size == len(expected[page.universe])
        found.setdefault(page.universe, []).extend(page.members)
    assert {u: sorted(m) for u, m in found.items()} == {u: sorted(m) for u, m in expected.items()}

    imported = universe.imported_symbols(tickers)
    nobody = spark.createDataFrame([], "universe string, symbol string")
    assert universe.universe_diff(imported, nobody).count() == sum(map(len, expected.values()))


def test_audits(spark, feed):
    _, count = brute(feed)
    parents = spark.createDataFrame([("S1",)], "symbol string")
    orphans = audit.audit_fk(feed, "symbol", parents, "symbol")
    assert {r.value: r.rows for r in orphans.collect()} == {s: n for s, n in count.items() if s != "S1"}
    copies = audit.audit_unique(feed, ["symbol"])
    assert {r.symbol: r.copies for r in copies.collect()} == {s: n for s, n in count.items() if n > 1}
