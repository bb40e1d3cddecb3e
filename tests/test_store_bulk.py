"""Large batches: each row moves once, and nothing half-done counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from closingbell import schemas
from closingbell.operators import keyed
from closingbell.sources import prices
from plan_text import plan_of

D23, D24 = dt.date(2023, 12, 29), dt.date(2024, 1, 2)


def bars(spark, *found):
    rows = [(s, d, c, c, c, c, 1) for s, d, c in found]
    return spark.createDataFrame(rows, schemas.BAR)


def rows(table):
    return sorted((r.symbol, r.date, r.close) for r in table.read().collect())


@pytest.fixture
def table(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path / "prices"))
    prices.upsert_prices(table, bars(spark, ("A", D23, 1.0), ("A", D24, 2.0), ("B", D24, 3.0)))
    return table


def test_bars_dealt_by_key_are_not_shuffled_again(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path))
    folded = prices.with_year(bars(spark, ("A", D24, 1.0)).groupBy("symbol", "date").agg(
        *(F.max(c).alias(c) for c in prices.VALUES)))
    rows, _ = table._clustered(folded.withColumn("v", F.col("year") * 0 + 1))
    assert plan_of(rows).count("Exchange hashpartitioning") == 1


def test_probed_years_are_merged_without_a_comparison(spark, table, monkeypatch):
    monkeypatch.setattr(prices, "PROBE_FROM", 1)
    monkeypatch.setattr(prices, "PROBE_PART", 1)
    batch = bars(spark, ("A", D24, 9.0), ("C", D24, 4.0))
    with monkeypatch.context() as patch:
        patch.setattr(prices, "_meeting", None)
        assert prices.upsert_prices(table, batch) == 2
    merged = [("A", D23, 1.0), ("A", D24, 9.0), ("B", D24, 3.0), ("C", D24, 4.0)]
    assert rows(table) == merged and table.versions == {2023: 1, 2024: 2}
    # what the probe does not settle is compared whole
    assert prices.upsert_prices(table, batch) == 2
    assert rows(table) == merged and table.versions == {2023: 1, 2024: 2}


@pytest.mark.parametrize("probe_from", [1, 10**9])
def test_copies_in_any_year_leave_every_year(spark, table, monkeypatch, probe_from):
    monkeypatch.setattr(prices, "PROBE_FROM", probe_from)
    monkeypatch.setattr(prices, "PROBE_PART", 1)
    before = rows(table), dict(table.versions)
    later = dt.date(2025, 1, 2)
    for copied in (D24, later):
        batch = bars(spark, ("A", D24, 9.0), ("A", later, 1.0), ("Z", copied, 1.0), ("Z", copied, 1.0))
        with pytest.raises(keyed.DuplicateKeys):
            prices.upsert_prices(table, batch)
        assert (rows(table), table.versions) == before


def test_bars_without_symbol_or_date(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path))
    odd = bars(spark, (None, D24, 1.0), ("A", None, 2.0), ("A", D24, 3.0))
    assert prices.upsert_prices(table, odd) == 3
    assert table.versions == {2024: 1} and table.read().count() == 2
    twice = bars(spark, ("A", None, 2.0), ("A", None, 5.0))
    for target in (table, prices.price_table(spark, str(tmp_path / "other"))):
        with pytest.raises(keyed.DuplicateKeys):
            prices.upsert_prices(target, twice)
