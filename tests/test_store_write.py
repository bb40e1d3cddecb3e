"""How rows of several years are written: sorted by key alone, the years beside each other."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from closingbell import schemas
from closingbell.operators.keyed import DuplicateKeys
from closingbell.sources import prices, years
from plan_text import plan_of

NAMES = [f"S{n}" for n in range(40)]
YEARS = list(range(2001, 2007))


def bars(spark):
    rows = [(s, dt.date(y, m, 3), 1.0, 2.0, 0.5, float(y + m), 7) for y in YEARS for m in (5, 1) for s in NAMES]
    return spark.createDataFrame(rows[::-1], schemas.BAR)


def test_a_sort_starts_with_the_key(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path))
    rows, _ = table._clustered(prices.with_year(bars(spark)).withColumn("v", F.col("year") * 0 + 1))
    sorts = [line for line in plan_of(rows).splitlines() if "Sort [" in line]
    assert len(sorts) == 1 and "Sort [symbol#" in sorts[0]


@pytest.mark.parametrize("most", [16, 1])
def test_files_of_several_years(spark, tmp_path, monkeypatch, most):
    """Also when a task meets more years than it may hold open."""
    monkeypatch.setattr(years, "OPEN_YEARS", most)
    table = prices.price_table(spark, str(tmp_path / "prices"))
    given = bars(spark)
    assert prices.upsert_prices(table, given.coalesce(1)) == len(YEARS) * 2 * len(NAMES)
    assert table.versions == {year: 1 for year in YEARS}
    stored = table.read()
    assert stored.drop("year").exceptAll(given).isEmpty() and given.exceptAll(stored.drop("year")).isEmpty()
    assert stored.filter(F.year("date") != F.col("year")).isEmpty()
    if most > len(YEARS):
        for path in table.paths():
            for file in {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).collect()}:
                found = [(r.symbol, r.date) for r in spark.read.parquet(file).collect()]
                assert found == sorted(found)


def test_the_session_keeps_its_setting(spark, tmp_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    prices.upsert_prices(prices.price_table(spark, str(tmp_path / "prices")), bars(spark))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_copies_are_refused_beside_other_years(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path / "prices"))
    given = bars(spark)
    with pytest.raises(DuplicateKeys):
        prices.upsert_prices(table, given.union(given.filter("symbol = 'S7' AND date = '2003-01-03'")))
    assert table.versions == {}
