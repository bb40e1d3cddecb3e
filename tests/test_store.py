import datetime as dt
import glob
import os

import pytest

import data
from closingbell import schemas
from closingbell.operators import keyed, maintenance
from closingbell.sources import prices, tables
from plan_text import plan_of

KEYED = ["symbol", "date", "close"]


def store_of(spark, root):
    return prices.price_table(spark, str(root))


def rows(table):
    return sorted(tuple(r) for r in table.read().select(KEYED).collect())


def files(table, *years):
    return sorted(f for p in table.paths(list(years) or None) for f in glob.glob(f"{p}/*.parquet"))


def bar(symbol, day, close):
    return (symbol, day, close, close, close, close, 10)


def frame(spark, *found):
    return spark.createDataFrame(list(found), schemas.BAR)


D23, D24 = dt.date(2023, 12, 29), dt.date(2024, 1, 2)


def test_absent_table_is_empty_and_other_errors_propagate(spark, tmp_path):
    assert store_of(spark, tmp_path).read().count() == 0
    table = prices.price_table(spark, str(tmp_path), {2024: 1})
    os.makedirs(tmp_path / "year=2024" / "v=1")
    (tmp_path / "year=2024" / "v=1" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        table.read().count()


def test_upsert_is_idempotent(spark, tmp_path):
    table = store_of(spark, tmp_path)
    first = frame(spark, bar("A", D23, 1.0), bar("A", D24, 2.0), bar("B", D24, 3.0))
    assert prices.upsert_prices(table, first) == 3
    batch = frame(spark, bar("A", D24, 9.0), bar("C", D24, 4.0))
    for _ in range(2):
        assert prices.upsert_prices(table, batch) == 2
        assert rows(table) == [("A", D23, 1.0), ("A", D24, 9.0), ("B", D24, 3.0), ("C", D24, 4.0)]
    assert table.versions == {2023: 1, 2024: 2}


def test_untouched_years_keep_their_files(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D23, 1.0), bar("A", D24, 2.0)))
    before = files(table, 2023)
    prices.upsert_prices(table, frame(spark, bar("A", D24, 5.0)))
    assert files(table, 2023) == before != []


def test_new_session_is_appended(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D24, 2.0)))
    before = files(table)
    prices.upsert_prices(table, frame(spark, bar("A", dt.date(2024, 1, 3), 3.0)))
    assert set(before) < set(files(table)) and table.versions == {2024: 1}


def test_retried_batch_rewrites_nothing(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D24, 2.0)))
    before = files(table)
    # the first attempt died before B was stored
    batch = frame(spark, bar("A", D24, 2.0), bar("B", D24, 3.0))
    assert prices.upsert_prices(table, batch) == 2
    after = files(table)
    assert set(before) < set(after) and table.versions == {2024: 1}
    assert rows(table) == [("A", D24, 2.0), ("B", D24, 3.0)]
    assert prices.upsert_prices(table, batch) == 2
    assert files(table) == after


def test_duplicate_batch_is_refused(spark, tmp_path):
    table = store_of(spark, tmp_path)
    with pytest.raises(keyed.DuplicateKeys):
        prices.upsert_prices(table, frame(spark, bar("A", D24, 2.0), bar("A", D24, 3.0)))
    assert prices.upsert_prices(table, frame(spark)) == 0
    assert table.versions == {}


def test_a_merge_that_did_not_count_leaves_the_table(spark, tmp_path):
    """A run's copy writes versions of its own; the same merge again starts from what counts."""
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, *[bar(s, D24, 2.0) for s in "ABCD"]))
    before, batch = rows(table), frame(spark, bar("A", D24, 9.0))
    lost = table.copy()
    prices.upsert_prices(lost, batch)
    assert rows(table) == before and rows(lost) != before
    prices.upsert_prices(table, batch)
    assert rows(table) == rows(lost) == [("A", D24, 9.0)] + [(s, D24, 2.0) for s in "BCD"]


def test_wrong_count_leaves_the_table_alone(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D24, 2.0)))
    before = files(table)
    with pytest.raises(RuntimeError, match="unchanged"):
        table.replace(prices.with_year(frame(spark, bar("A", D24, 1.0))), [2024], expected=2)
    assert files(table) == before


def test_a_year_without_rows_leaves_the_table(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D23, 1.0), bar("A", D24, 2.0)))
    left = table.read([2023, 2024]).filter("year = 2023")
    assert table.replace(left, [2023, 2024]) == {2023: 1, 2024: 0}
    assert rows(table) == [("A", D23, 1.0)] and table.versions == {2023: 2}


def test_compaction_reaches_its_size_and_stops(spark, tmp_path):
    """More threads than files, several files a year: the second compaction packs nothing."""
    table = store_of(spark, tmp_path)
    bars = spark.range(40_000).selectExpr(
        "concat('S', id % 80) AS symbol", "date_add(date'2023-01-02', cast(id div 80 AS int)) AS date",
        "rand(1) AS open", "rand(2) AS high", "rand(3) AS low", "rand(4) AS close", "id AS volume",
    )
    prices.upsert_prices(table, bars)
    for d in range(3):
        day = dt.date(2024, 12, 3) + dt.timedelta(days=d)
        prices.upsert_prices(table, frame(spark, *[bar(f"S{i}", day, 1.0) for i in range(40)]))
    before, target = rows(table), sum(os.path.getsize(f) for f in files(table)) // 9
    first = maintenance.compact_prices(table, target).collect()
    assert rows(table) == before
    for row in first:
        assert row.files_after <= -(-row.bytes_before // target)
    assert max(row.files_after for row in first) > 1
    kept = files(table)
    maintenance.compact_prices(table, target)
    assert files(table) == kept


def test_years_are_pruned_at_the_scan(spark, tmp_path):
    table = store_of(spark, tmp_path)
    prices.upsert_prices(table, frame(spark, bar("A", D23, 1.0), bar("A", D24, 2.0)))
    plan = plan_of(table.read().filter("year IN (2024)").select("symbol", "close"))
    assert "PartitionFilters: [isnotnull(year" in plan and "ReadSchema: struct<symbol:string,close:double>" in plan
    assert "year=2023" not in plan_of(table.read([2024]))


def small_files(table, n=6):
    for i in range(n):
        day = dt.date(2024, 1, 2) + dt.timedelta(days=i)
        prices.upsert_prices(table, frame(table.spark, *[bar(s, day, i + 1.0) for s in "ABC"]))


def test_compaction_keeps_every_bar(spark, tmp_path):
    table = store_of(spark, tmp_path)
    small_files(table)
    before, count = rows(table), len(files(table))
    metrics = maintenance.compact_prices(table).first()
    assert rows(table) == before
    assert (metrics.year, metrics.files_before, metrics.files_after) == (2024, count, 1)
    again = maintenance.compact_prices(table).first()
    assert again.files_before == again.files_after == 1 and table.versions == {2024: 2}


def test_orphans_respect_live_files_and_retention(spark, tmp_path):
    root, table = str(tmp_path), store_of(spark, tmp_path)
    small_files(table, 3)
    old = files(table)
    maintenance.compact_prices(table)
    now = dt.datetime.now(dt.timezone.utc)
    assert maintenance.orphan_files(spark, root, table.paths(), now).count() == 0
    later = now + dt.timedelta(hours=169)
    found = maintenance.orphan_files(spark, root, table.paths(), later)
    assert sorted(r.path.removeprefix("file:") for r in found.collect()) == old
    with pytest.raises(ValueError):
        maintenance.orphan_files(spark, root, table.paths(), now, retention_hours=1)
    short = maintenance.orphan_files(spark, root, table.paths(), now + dt.timedelta(hours=2), 1, allow_short=True)
    assert short.count() == found.count()
    before, listed = rows(table), found.persist()
    assert listed.count() == len(old) == maintenance.remove_files(spark, listed)
    assert not any(map(os.path.exists, old)) and rows(table) == before


def test_a_store_with_versions_is_not_opened_without_them(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path))
    store.write("membership", data.membership(spark, "A"))
    for versions in (None, {}):
        with pytest.raises(ValueError, match="versions"):
            tables.Store(spark, str(tmp_path), versions)


def test_rows_that_break_a_rule_are_refused(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path))
    store.write("universe", spark.createDataFrame([("u1", "u1", None, None)], schemas.UNIVERSE))
    store.write("membership", data.membership(spark, "A", "B"))
    good = dict(store.versions)
    with pytest.raises(tables.IntegrityError, match="unique"):
        store.write("membership", data.membership(spark, "A", "A"))
    with pytest.raises(tables.IntegrityError, match="required"):
        store.write("membership", data.membership(spark, "A", "MUCH-TOO-LONG"))
    with pytest.raises(tables.IntegrityError, match="fk:universe_id"):
        store.write("universe_membership", data.stints(spark, [("A", "u2", D23, None)]))
    with pytest.raises(tables.IntegrityError, match="active_unique"):
        store.write("universe_membership", data.stints(spark, [("A", "u1", D23, None), ("A", "u1", D24, None)]))
    assert store.versions == good and store.read("membership").count() == 2
    store.write("universe_membership", data.stints(spark, [("A", "u1", D23, D24), ("A", "u1", D24, None)]))


def test_versions_leave_the_old_one_readable(spark, tmp_path):
    store = tables.Store(spark, str(tmp_path))
    assert store.read("membership").count() == 0
    store.write("membership", data.membership(spark, "A"))
    old = dict(store.versions)
    store.write("membership", store.read("membership").union(data.membership(spark, "B")))
    assert store.read("membership").count() == 2
    assert tables.Store(spark, str(tmp_path), old).read("membership").count() == 1
