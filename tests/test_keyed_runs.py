import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import data
from closingbell import schemas
from closingbell.operators import audit, failures, keyed, maintenance, runs

LATER = "2024-01-04 06:30:00"
FAILURE = "symbol string, seq bigint, failure string, failure_error string"


def fixed(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


rows = st.dictionaries(st.integers(0, 5), st.integers(0, 9), max_size=5)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(stored=rows, batch=rows)
def test_replace_rows_is_an_idempotent_merge(spark, stored, batch):
    schema = "k int, v int"
    target = spark.createDataFrame(list(stored.items()), schema)
    source = spark.createDataFrame(list(batch.items()), schema)
    once = keyed.replace_rows(target, source, ["k"])
    assert pairs(once) == sorted((stored | batch).items())
    assert pairs(keyed.replace_rows(once, source, ["k"])) == pairs(once)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(listed=st.sets(st.integers(0, 4)), values=st.lists(st.integers(0, 5), max_size=20))
def test_keep_listed_is_a_semi_join(spark, listed, values):
    frame = spark.createDataFrame(list(enumerate(values)), "id int, k int")
    wanted = spark.createDataFrame([(k,) for k in listed] * 2, "k int")
    kept = keyed.keep_listed(frame, wanted, ["k"], ["id"])
    assert pairs(kept.select("id")) == sorted((i,) for i, k in enumerate(values) if k in listed)


def test_partial_update_keeps_other_columns(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, first string, v double")
    changes = spark.createDataFrame([(2, "new", 9.0), (3, "c", 3.0)], "k int, first string, v double")
    after = keyed.upsert(target, changes, ["k"], {"v": F.col("new.v") + F.col("old.v")})
    assert pairs(after) == [(1, "a", 1.0), (2, "b", 11.0), (3, "c", 3.0)]


def test_duplicate_source_is_an_error(spark):
    with pytest.raises(keyed.DuplicateKeys):
        keyed.require_unique(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    keyed.require_unique(spark.createDataFrame([(1,), (2,)], "k int"), ["k"])


def test_replace_slice_removes_stale_rows(spark):
    schema = "k string, day int, note string"
    old = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("B", 2, "z"), ("C", 2, "w")], schema)
    evaluated = spark.createDataFrame([("A", 2), ("B", 2), ("B", 2)], "k string, day int")
    fresh = spark.createDataFrame([("B", 2, "again")], schema)
    assert pairs(keyed.replace_slice(old, evaluated, fresh, ["k", "day"])) == [
        ("A", 1, "x"), ("B", 2, "again"), ("C", 2, "w")
    ]


def test_dead_letter_sequence(spark):
    members = data.membership(spark, "A", "B")
    dlq = data.empty(spark, "failed_ingestion")

    def fail(table, now, *errors):
        frame = spark.createDataFrame(
            [(s, i, "VALIDATION", e) for i, (s, e) in enumerate(errors)], FAILURE
        )
        return fixed(spark, failures.record_failures(table, frame, members, now))

    def row(table):
        return {r.raw_symbol: r for r in table.collect()}["A"]

    dlq = fail(dlq, data.NOW, ("A", "one"), ("X", "unknown"))
    assert (row(dlq).attempts, row(dlq).review_required, dlq.count()) == (1, False, 1)
    first_id = row(dlq).id
    dlq = fail(dlq, LATER, ("A", "two"))
    assert (row(dlq).attempts, row(dlq).review_required) == (2, False)
    dlq = fail(dlq, LATER, ("A", "three"))
    assert (row(dlq).attempts, row(dlq).review_required, row(dlq).failure_error) == (3, True, "three")
    assert row(dlq).id == first_id and row(dlq).retry_after == dt.datetime(2024, 1, 4, 7, 30)
    assert row(dlq).created_at == dt.datetime(2024, 1, 4, 6, 30)
    assert failures.count_since(dlq, LATER).first().failures == 1
    written = spark.createDataFrame([("A",), ("A",)], "symbol string")
    dlq = fixed(spark, failures.clear_resolved(dlq, written, members))
    assert dlq.count() == 0
    dlq = fail(dlq, LATER, ("A", "x"), ("A", "y"), ("A", "z"), ("B", "q"))
    assert (row(dlq).attempts, row(dlq).review_required, row(dlq).failure_error) == (3, True, "z")


def test_baselines_keep_absent_symbols(spark):
    members = data.membership(spark, "A", "B")
    stored = schemas.conform(
        spark.createDataFrame([("v1", "id-A", 0.1, 10.0), ("v2", "id-B", 0.2, 20.0)],
                              "id string, symbol_id string, rolling_sd double, rolling_avg_volume double"),
        "volatility_rolling", data.NOW,
    )
    rolling = spark.createDataFrame([("A", 0.5, 50.0), ("X", 0.6, 60.0)],
                                    "symbol string, rolling_sd double, rolling_avg_volume double")
    after = {r.symbol_id: r for r in failures.update_baselines(stored, rolling, members, LATER).collect()}
    assert set(after) == {"id-A", "id-B"}
    assert (after["id-A"].id, after["id-A"].rolling_sd) == ("v1", 0.5)
    assert after["id-A"].created_at == dt.datetime(2024, 1, 3, 6, 30)
    assert after["id-A"].updated_at == dt.datetime(2024, 1, 4, 6, 30)
    assert after["id-B"].rolling_sd == 0.2


STATUS = [
    ((0, 10, 10), ("FAILED", 0, 10, False)),
    ((5, None, 0), ("SUCCESS", 5, 0, False)),
    ((5, None, 2), ("PARTIAL", 5, 2, False)),
    ((8, 10, 2), ("PARTIAL", 8, 2, False)),
    ((8, 10, 0), ("PARTIAL", 8, 2, True)),
    ((10, 10, 1), ("PARTIAL", 10, 0, True)),
    ((10, 10, 0), ("SUCCESS", 10, 0, False)),
    ((12, 10, 0), ("SUCCESS", 12, 0, False)),
]


def test_status_truth_table(spark):
    frame = spark.createDataFrame(
        [(str(i), *case) for i, (case, _) in enumerate(STATUS)],
        "id string, written bigint, attempted bigint, dlq_failures bigint",
    )
    found = {r.id: tuple(r)[1:] for r in runs.derive_status(frame).collect()}
    assert [found[str(i)] for i in range(len(STATUS))] == [want for _, want in STATUS]


def log(spark):
    table = data.empty(spark, "pipeline_run")
    for i, now in enumerate(["2024-01-03 06:30:00", "2024-01-03 07:30:00", "2024-01-04 06:30:00"]):
        table = fixed(spark, runs.start_run(spark, table, f"r{i}", "prices", now[:10], now))
    return table


def test_run_log(spark):
    table = log(spark)
    assert {(r.status, r.records_processed, r.completed_at) for r in table.collect()} == {("RUNNING", 0, None)}
    outcome = spark.createDataFrame([("r0", 8, 10, 2), ("nobody", 1, 1, 0)],
                                    "id string, written bigint, attempted bigint, dlq_failures bigint")
    closed = {r.id: r for r in runs.close_runs(table, outcome, LATER).collect()}
    assert len(closed) == 3 and closed["r1"].status == "RUNNING"
    assert (closed["r0"].status, closed["r0"].records_processed, closed["r0"].records_failed) == ("PARTIAL", 8, 2)
    assert [r.id for r in runs.latest_runs(table, 2).collect()] == ["r2", "r1"]
    done = {r.id: r.status for r in runs.succeed_run(table, "r2", LATER).collect()}
    assert done == {"r0": "RUNNING", "r1": "RUNNING", "r2": "SUCCESS"}


def test_failed_run_by_id_or_latest(spark):
    frame = spark.createDataFrame(
        [("r2", "prices", "2024-01-04", "by id"), (None, "prices", "2024-01-03", "by date"),
         (None, "prices", "1999-01-01", "no run"), ("nobody", "prices", "2024-01-03", "no id")],
        "id string, dag_id string, run_date string, error string",
    ).withColumn("run_date", F.col("run_date").cast("date"))
    after = {r.id: (r.status, r.notes) for r in runs.fail_runs(log(spark), frame, LATER).collect()}
    assert after == {"r0": ("RUNNING", None), "r1": ("FAILED", "by date"), "r2": ("FAILED", "by id")}


def test_audits_find_each_violation(spark):
    at = dt.datetime(2024, 1, 1)
    tables = {
        "membership": spark.createDataFrame(
            [("m1", "A", at, at), ("m2", "A", at, at), ("m3", None, at, at), ("m4", "TOOLONGSYMBOL", at, at)],
            schemas.MEMBERSHIP),
        "pipeline_run": spark.createDataFrame(
            [("p1", "d", dt.date(2024, 1, 1), "DONE", at, None, 0, 0, None),
             ("p2", "d", dt.date(2024, 1, 1), None, at, None, 0, 0, None)], schemas.PIPELINE_RUN),
        "volatility_rolling": spark.createDataFrame([("v", "ghost", at, at, 0.1, 1.0)], schemas.VOLATILITY),
        "universe_membership": data.stints(
            spark, [("A", "u", data.DAY, None), ("A", "u", data.DAY, None), ("A", "u", data.DAY, data.DAY)]),
    }
    found = {
        (r.table, r.rule): r.violations
        for name in tables for r in audit.violations(tables, name).collect()
    }
    assert found["membership", "unique"] == 1 and found["membership", "required"] == 2
    assert found["pipeline_run", "values:status"] == 1 and found["pipeline_run", "unique"] == 0
    assert found["volatility_rolling", "fk:symbol_id"] == 1
    assert found["universe_membership", "active_unique"] == 1
    assert found["universe_membership", "fk:membership_id"] == 1


def test_retention_is_anchored_to_the_run_date(spark):
    frame = spark.createDataFrame(
        [(dt.datetime(2024, 1, 16),), (dt.datetime(2024, 1, 15, 23, 59),)], "ts timestamp_ntz")
    kept = maintenance.retention_purge(frame, "ts", "2024-02-15").collect()
    assert [r.ts for r in kept] == [dt.datetime(2024, 1, 16)]


def test_defaults_fill_new_rows(spark):
    row = schemas.conform(spark.createDataFrame([("s",)], "symbol_id string"), "failed_ingestion", data.NOW).first()
    assert (row.attempts, row.review_required, row.created_at) == (0, False, dt.datetime(2024, 1, 3, 6, 30))
