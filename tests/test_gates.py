import datetime as dt

import pytest

import data
from closingbell.operators import calendar, gates
from plan_text import plan_of

STALE = dt.date(2023, 12, 29)

CASES = {
    "good": (200, data.body(data.candle()), None),
    "status": (500, "x" * 300, ("HTTP_ERROR", "status: HTTP 500 — " + "x" * 200)),
    "noStatus": (None, data.body(data.candle()), ("HTTP_ERROR", "HTTP None")),
    "empty": (200, data.body(data.candle(), empty=True), ("HTTP_ERROR", "empty: empty response from vendor")),
    "noneLeft": (200, data.body(), ("HTTP_ERROR", "empty response")),
    "noCandles": (200, '{"empty": false}', ("HTTP_ERROR", "empty response")),
    "html": (200, "<html>", ("HTTP_ERROR", "html: unparseable response from vendor")),
    "noBody": (200, None, ("HTTP_ERROR", "unparseable")),
    "blank": (200, "", ("HTTP_ERROR", "unparseable")),
    "stale": (200, data.body(data.candle(STALE)),
              ("VALIDATION", "stale: candle date 2023-12-29 != expected 2024-01-02")),
    "lastCounts": (200, data.body(data.candle(STALE), data.candle()), None),
    "noDate": (200, data.body(data.candle(datetime=None)),
               ("VALIDATION", "candle date None != expected 2024-01-02")),
    "farDate": (200, data.body(data.candle(datetime=10**18)), ("VALIDATION", "candle date None")),
    "nullCandle": (200, '{"candles":[null]}', ("VALIDATION", "candle date None")),
    "openNull": (200, data.body(data.candle(open=None)),
                 ("VALIDATION", "openNull: field 'open' missing or non-positive (got None)")),
    "highZero": (200, data.body(data.candle(high=0)), ("VALIDATION", "field 'high' missing or non-positive (got 0)")),
    "lowText": (200, data.body(data.candle(low="5")), ("VALIDATION", "field 'low'")),
    "closeNan": (200, data.body(data.candle(close=float("nan"))), ("VALIDATION", "field 'close'")),
    "volumeNeg": (200, data.body(data.candle(volume=-1)), ("VALIDATION", "field 'volume' missing or non-positive (got -1)")),
    "volumeNan": (200, data.body(data.candle(volume=float("nan"))), ("VALIDATION", "field 'volume'")),
    "volumeHuge": (200, data.body(data.candle(volume=1e300)), ("VALIDATION", "field 'volume'")),
    "volumeHalf": (200, data.body(data.candle(volume=0.5)), None),
    "twoFaults": (200, data.body(data.candle(STALE, open=None)), ("VALIDATION", "candle date 2023-12-29")),
    "openThenLow": (200, data.body(data.candle(open=-2, low=0)), ("VALIDATION", "field 'open' missing or non-positive (got -2)")),
    "highLow": (200, data.body(data.candle(high=104)),
                ("VALIDATION", "high 104.0 does not dominate open=100.0 close=105.0 low=99.0")),
    "bigHigh": (200, data.body(data.candle(high=2, open=12345678.25, close=1e7)),
                ("VALIDATION", "high 2.0 does not dominate open=12345678.25 close=10000000.0 low=99.0")),
    "lowHigh": (200, data.body(data.candle(low=101)),
                ("VALIDATION", "low 101.0 does not undercut open=100.0 close=105.0")),
}


@pytest.fixture(scope="module")
def gated(spark):
    rows = [(name, status, text) for name, (status, text, _) in CASES.items()]
    frame = gates.gate_payloads(data.landing(spark, rows), data.calendar(spark))
    return {row.symbol: row for row in frame.collect()}


@pytest.mark.parametrize("name", CASES)
def test_first_failure_decides(gated, name):
    expected = CASES[name][2]
    reject = gated[name]
    if expected is None:
        assert reject.gate is None and reject.failure is None and reject.failure_error is None
    else:
        assert reject.failure == expected[0]
        assert expected[1] in reject.failure_error
        assert reject.failure_error.startswith(f"{name}: ")


def test_accepted_bars_are_typed(spark):
    rows = [("HALF", 200, data.body(data.candle(volume=0.5))), ("BAD", 404, "")]
    gated = gates.gate_payloads(data.landing(spark, rows), data.calendar(spark))
    accepted = gates.accepted_bars(gated).collect()
    assert [(r.symbol, r.date, r.close, r.volume) for r in accepted] == [("HALF", data.DAY, 105.0, 0)]
    assert [r.symbol for r in gates.rejections(gated).collect()] == ["BAD"]


def test_no_session_in_reach_rejects(spark):
    far = data.calendar(spark).filter("session_date < '2023-12-01'")
    row = gates.gate_payloads(data.landing(spark, [("A", 200, data.body(data.candle()))]), far).first()
    assert row.failure_error == "A: candle date 2024-01-02 != expected None"


def test_previous_session_skips_gaps(spark):
    found = {r.as_of: r.prev_session for r in calendar.previous_sessions(data.calendar(spark)).collect()}
    assert found[dt.date(2024, 1, 2)] == dt.date(2023, 12, 29)
    assert found[dt.date(2024, 1, 3)] == dt.date(2024, 1, 2)
    assert found[dt.date(2024, 1, 13)] == dt.date(2024, 1, 3)
    assert dt.date(2024, 1, 14) not in found


def test_keep_last_by_arrival(spark):
    feed = spark.createDataFrame(
        [("A", 1, 10.0), ("A", 3, 30.0), ("A", 2, 20.0), ("B", 1, 5.0)], "symbol string, seq int, close double"
    )
    kept = gates.keep_last(feed, ["symbol"], ["seq"])
    assert {(r.symbol, r.close) for r in kept.collect()} == {("A", 30.0), ("B", 5.0)}


def test_copies_are_dropped_before_the_shuffle(spark):
    feed = spark.range(10).selectExpr("id % 3 AS key", "id AS seq")
    plan = plan_of(gates.keep_last(feed, ["key"], ["seq"]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_a_payload_is_parsed_once(spark):
    gated = gates.gate_payloads(data.landing(spark, [("A", 200, "")]), data.calendar(spark))
    columns = gates.accepted_bars(gated)
    assert plan_of(columns).count("from_json(StructField(empty") == 1


def test_messages_are_formatted_for_what_a_filter_leaves(spark):
    """Formatting and the second reading of a body stand once in the plan, above the filter."""
    gated = gates.gate_payloads(data.landing(spark, [("A", 200, "")]), data.calendar(spark))
    plan = plan_of(gates.rejections(gated).filter("gate = 'positive'"))
    assert plan.count("does not dominate") == 1 and plan.count("unparseable") == 1
    lines = plan.splitlines()
    message = next(i for i, line in enumerate(lines) if "does not dominate" in line)
    kept = next(i for i, line in enumerate(lines) if "Filter (CASE WHEN" in line)
    assert message < kept and "format_string" not in lines[kept] and "from_json" not in lines[kept]


def test_bodies_stay_behind(spark):
    gated = gates.gate_payloads(data.landing(spark, [("A", 200, "")]), data.calendar(spark))
    assert "body" not in gated.columns
