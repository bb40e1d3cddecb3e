"""State of baselines, bucketed layout, as-of join, digest diff, pushed lists, rejected lines, counted writes."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import data
from closingbell import schemas
from closingbell.operators import audit, stats, universe
from closingbell.operators.asof import asof_join
from closingbell.operators import flags
from closingbell.sources import prices, tables, tickers
from closingbell.sources.bucketed import save_bucketed
from closingbell.sources.years import observed
from plan_text import plan_of

START = dt.date(2023, 1, 2)


def days(n):
    return [START + dt.timedelta(days=i) for i in range(n)]


def walk(spark, symbols, n, seed=1):
    rng = random.Random(seed)
    rows = []
    for s in symbols:
        for day in days(n):
            if rng.random() < 0.8:
                close = 50 + 50 * rng.random()
                rows.append((s, day, close, close, close, close, rng.randint(1, 99)))
    return spark.createDataFrame(rows, schemas.BAR)


def test_merged_state_gives_the_baselines_of_the_history(spark):
    """Batch after batch, also one that comes late and one that corrects a stored bar."""
    bars = walk(spark, "ABCDE", 60).persist()
    cuts = [days(60)[i] for i in (0, 30, 31, 45)] + [dt.date(2030, 1, 1)]
    parts = [bars.filter((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b))) for a, b in zip(cuts, cuts[1:])]
    state = stats.newest_bars(parts[0].select("symbol", "date", "close", "volume"), 21)
    for part in (parts[1], parts[3], parts[2]):
        state = stats.merge_recent(state, part)
    fixed = bars.filter("date = '2023-02-20'").withColumn("close", F.col("close") + 1)
    state = stats.merge_recent(state, fixed)
    whole = prices.merge_bars(bars, fixed)
    rounded = lambda df: sorted((r.symbol, round(r.rolling_sd, 9), r.rolling_avg_volume) for r in df.collect())
    assert rounded(stats.rolling_stats(state)) == rounded(stats.rolling_stats(whole)) != []
    assert state.groupBy("symbol").count().agg(F.max("count")).first()[0] == 21


def test_bucketed_history_is_annotated_without_a_shuffle(spark, tmp_path):
    bars = walk(spark, "ABCDEFGH", 40)
    table = save_bucketed(bars, "bucketed_test", str(tmp_path / "b"), 4)
    annotated = flags.flag_history(table)
    plan = plan_of(annotated)
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
    key = lambda df: sorted(map(str, df.drop("rules").collect()))
    assert key(annotated) == key(flags.flag_history(bars))
    # a batch joined on the symbol moves alone
    other = spark.createDataFrame([("A", 0.5), ("B", 0.1)], "symbol string, rolling_sd double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = plan_of(table.join(other, "symbol"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count("Exchange") == 1
    spark.sql("DROP TABLE bucketed_test")


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 10])
def test_asof_against_bisection(spark, strict, tolerance):
    rng = random.Random(3)
    right = [(k, d, rng.random()) for k in "AB" for d in rng.sample(days(400), 40)]
    left = [(i, rng.choice(["A", "A", "B", "C", None]), rng.choice([None, *days(450)])) for i in range(300)]
    left += [(1000 + i, "A", days(400)[200]) for i in range(50)]
    frames = (
        spark.createDataFrame(left, "id int, k string, at date"),
        spark.createDataFrame(right + [("A", None, 0.0), (None, START, 0.0)], "k string, at date, v double"),
    )
    within = None if tolerance is None else F.make_dt_interval(F.lit(tolerance))
    found = asof_join(*frames, ["k"], "at", strict=strict, tolerance=within)
    known = {k: sorted((d, v) for kk, d, v in right if kk == k) for k in "AB"}
    wanted = []
    for i, k, at in left:
        match = (None, None)
        if k in known and at is not None:
            n = (bisect.bisect_left if strict else bisect.bisect_right)([d for d, _ in known[k]], at)
            if n and (tolerance is None or (at - known[k][n - 1][0]).days <= tolerance):
                match = known[k][n - 1]
        wanted.append((i, k, at, *match))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, wanted))


def test_asof_refuses_clashing_columns(spark):
    one = spark.createDataFrame([("A", START, 1)], "k string, at date, v int")
    with pytest.raises(ValueError, match="v"):
        asof_join(one, one, ["k"], "at")


def stored_universe(spark, symbols, gone=()):
    members = spark.createDataFrame([(s,) for s in symbols], "symbol string")
    members = universe.insert_memberships(data.empty(spark, "membership"), members.selectExpr("'u' AS universe", "symbol", "'new' AS change"), data.NOW)
    ids = {r.symbol: r.id for r in members.collect()}
    at = dt.datetime(2020, 1, 1)
    rows = [
        (f"um-{u}-{s}", ids[s], u, START, START if s in gone else None, at, at, None)
        for u in ("u1", "u2") for s in symbols
    ]
    return members, spark.createDataFrame(rows, schemas.UNIVERSE_MEMBERSHIP)


def test_digest_diff_is_the_diff_and_looks_up_only_what_differs(spark):
    symbols = [f"S{i}" for i in range(300)]
    members, history = stored_universe(spark, symbols, gone={"S7"})
    frame = lambda rows: spark.createDataFrame(rows, "universe string, symbol string")
    same = frame([("u1", s) for s in symbols if s != "S7"] * 2)
    assert universe.diff_by_digest(same, history, members).collect() == []
    changed = frame([("u1", s) for s in symbols[1:]] + [("u1", "NEW"), ("u3", "S1")])
    found = universe.diff_by_digest(changed, history, members, buckets=64)
    active = universe.active_by_universe(history, members, changed)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(found) == key(universe.universe_diff(changed, active)) == [
        ("u1", "NEW", "new"), ("u1", "S0", "delisted"), ("u1", "S7", "new"), ("u3", "S1", "new"),
    ]
    # ids that don't follow from the symbol: everything is compared
    odd = members.withColumn("id", F.concat(F.lit("x"), "id"))
    moved = history.withColumn("membership_id", F.concat(F.lit("x"), "membership_id"))
    assert key(universe.diff_by_digest(changed, moved, odd)) == key(found)


def test_a_short_list_reaches_the_scan(spark, tmp_path):
    table = prices.price_table(spark, str(tmp_path))
    prices.upsert_prices(table, walk(spark, [f"S{i}" for i in range(30)], 10))
    asked = spark.createDataFrame([("S3",), ("S3",), ("S9",), ("NONE",)], "symbol string")
    short = prices.of_symbols(table.read(), asked)
    assert "PushedFilters: [In(symbol, [NONE,S3,S9])]" in plan_of(short).replace('"', "")
    long = prices.of_symbols(table.read(), asked, most=2)
    assert sorted(map(str, short.collect())) == sorted(map(str, long.collect())) != []


def test_bad_lines_are_rejected_and_counted(spark, tmp_path):
    path = tmp_path / "tickers.csv"
    path.write_text('ticker,universe\nA,u1\nB\nC,u1,more\nC,u1,more\n"D ""x""",u2\nE,u1\n')
    kept = tickers.scan_tickers(spark, str(path), keep_rest=True).collect()
    assert {tuple(r) for r in kept} == {("A", "u1"), ('D "x"', "u2"), ("E", "u1")} and len(kept) == 3
    rejected = {r.line: r.rows for r in tickers.rejected_lines(spark, str(path)).collect()}
    assert rejected == {"B": 1, "C,u1,more": 2}


def test_metrics_are_collected_by_the_write(spark, tmp_path):
    rows, seen = observed(spark.range(100), n=F.count(F.lit(1)), top=F.max("id"))
    rows.repartition(4).write.parquet(str(tmp_path / "a"))
    assert seen.get == {"n": 100, "top": 99}
    none, seen = observed(spark.range(100).filter("id < 0"), n=F.count(F.lit(1)), top=F.max("id"))
    none.write.parquet(str(tmp_path / "b"))
    assert seen.get == {"n": 0, "top": None}


def test_all_rules_in_one_pass(spark, tmp_path):
    """The one pass counts what the audits of each rule list."""
    store = tables.Store(spark, str(tmp_path))
    members = data.membership(spark, "A", "B", "B", "MUCH-TOO-LONG")
    stints = data.stints(spark, [("A", "u1", START, None), ("A", "u1", START, None), ("Z", "u2", START, None), ("B", None, START, None)])
    named = spark.createDataFrame([("u1", "u1", None, None)], schemas.UNIVERSE)
    found = {"membership": members, "universe_membership": stints, "universe": named}
    for name in found:
        counted = {r.rule: r.violations for r in audit.violations(found, name).collect()}
        assert counted == {rule: rows.count() for rule, rows in audit.audit_table(found, name).items()}
    plan = plan_of(audit.violations(found, "universe_membership"))
    assert plan.count("Generate explode") <= 2
    with pytest.raises(tables.IntegrityError):
        store.write("membership", members)
    assert not (tmp_path / "membership").exists()
