"""The same results in plain SQL on the given tables, written without the engine.

``VIEWS`` are the twins of ``workload.views``; ``SQL`` holds one statement per query. A
statement gets the views it names put in front of it.
"""

from __future__ import annotations

import re

NOW = "TIMESTAMP '2002-01-01 06:30:00'"
LISTED = "TIMESTAMP '1995-01-02 00:00:00'"
AS_OF = "DATE '2001-12-31'"


def _bars(source: str, volume: str) -> str:
    return f"""
        SELECT 'T/' || key AS symbol, date,
               first(price ORDER BY ord) AS open, max(price) AS high, min(price) AS low,
               last(price ORDER BY ord) AS close, {volume} AS volume
        FROM {source} GROUP BY key, date"""


def _id(kind: str, *keys: str) -> str:
    return f"sha256(concat_ws(chr(1), '{kind}', {', '.join(keys)}))"


def _landing_field(name: str, value: str) -> str:
    return f"""'"{name}":' || {value}"""


_MS = "(CAST(date_diff('day', DATE '1970-01-01', date) AS BIGINT) * 86400000 + 18000000)"


def _cents(name: str) -> str:
    return f"CAST(round({name} * 100) AS BIGINT)"


_CANDLE = " || ',' || ".join(
    [
        _landing_field(
            "datetime",
            f"CASE WHEN volume = 11 THEN 'null' WHEN volume = 4 "
            f"THEN CAST({_MS} - 5 * 86400000 AS VARCHAR) ELSE CAST({_MS} AS VARCHAR) END",
        ),
        _landing_field(
            "open",
            f"CASE WHEN volume = 5 THEN 'null' WHEN volume = 9 "
            f"THEN CAST({_cents('low')} - 1 AS VARCHAR) ELSE CAST({_cents('open')} AS VARCHAR) END",
        ),
        _landing_field(
            "high",
            f"CASE WHEN volume = 6 THEN '0' WHEN volume = 8 "
            f"THEN CAST({_cents('close')} - 1 AS VARCHAR) ELSE CAST({_cents('high')} AS VARCHAR) END",
        ),
        _landing_field("low", f"CAST({_cents('low')} AS VARCHAR)"),
        _landing_field(
            "close",
            f"CASE WHEN volume = 13 THEN '-7' ELSE CAST({_cents('close')} AS VARCHAR) END",
        ),
        _landing_field(
            "volume",
            "CASE WHEN volume = 7 THEN '-3' WHEN volume = 12 THEN '0.5' "
            "ELSE CAST(volume AS VARCHAR) END",
        ),
    ]
)

FIELDS = ("open", "high", "low", "close", "volume")

def _failed(verdicts: str) -> str:
    return f"""
        SELECT symbol, CAST(count(*) AS INTEGER) AS attempts, last(failure ORDER BY seq) AS failure,
               last(failure_error ORDER BY seq) AS failure_error
        FROM {verdicts} WHERE gate IS NOT NULL GROUP BY symbol"""


def _dlq_after(failed: str) -> str:
    return f"""
        SELECT CASE WHEN d.id IS NULL THEN {_id('failed_ingestion', 'm.id', "'2002-01-01 06:30:00'")}
               ELSE d.id END AS id,
               coalesce(d.symbol_id, m.id) AS symbol_id, coalesce(d.raw_symbol, f.symbol) AS raw_symbol,
               CASE WHEN f.symbol IS NULL THEN d.created_at ELSE {NOW} END AS created_at,
               coalesce(f.failure, d.failure) AS failure,
               coalesce(f.failure_error, d.failure_error) AS failure_error,
               CASE WHEN f.symbol IS NULL THEN d.retry_after ELSE {NOW} + INTERVAL 1 HOUR END
                   AS retry_after,
               CAST(coalesce(d.attempts, 0) + coalesce(f.attempts, 0) AS INTEGER) AS attempts,
               coalesce(d.attempts, 0) + coalesce(f.attempts, 0) >= 3 AS review_required
        FROM ({failed} f JOIN membership m ON m.symbol = f.symbol)
        FULL JOIN dlq d ON d.symbol_id = m.id"""


def _returns(bars: str) -> str:
    return f"""
        SELECT *, CASE WHEN year(lag(date) OVER w) >= year(date) - 1 THEN lag(close) OVER w END
                   AS prev_close,
               ln(close) - ln(lag(close) OVER w) AS r, lag(date, 21) OVER w AS oldest
        FROM {bars} WINDOW w AS (PARTITION BY symbol ORDER BY date)"""


def _measured(returns: str) -> str:
    return f"""
        SELECT symbol, date, open, high, low, close, volume, prev_close,
               CASE WHEN count(r) OVER w = 20 AND year(oldest) >= year(date) - 1
                   THEN stddev_samp(r) OVER w END AS rolling_sd,
               CASE WHEN count(r) OVER w = 20 AND year(oldest) >= year(date) - 1
                   THEN avg(CAST(volume AS DOUBLE)) OVER w END AS rolling_avg_volume
        FROM {returns}
        WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"""


VIEWS = {
    "ticks": """
        SELECT l_suppkey AS key, CAST(l_shipdate AS DATE) AS date,
               l_extendedprice / l_quantity AS price, l_quantity AS qty,
               row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS ord, l_returnflag
        FROM lineitem""",
    "bars": _bars("ticks", "CAST(sum(qty) AS BIGINT)"),
    "returned_ticks": "SELECT * FROM ticks WHERE l_returnflag = 'R'",
    "returned_bars": _bars("returned_ticks", "CAST(sum(qty) AS BIGINT)"),
    "event_ticks": """
        SELECT user_id AS key, CAST(ts AS DATE) AS date, value AS price, row(ts, event_id) AS ord
        FROM events""",
    "event_bars": _bars("event_ticks", "CAST(round(sum(price) * 100) AS BIGINT)"),
    "corrections": "SELECT * FROM returned_bars UNION ALL SELECT * FROM event_bars",
    "merged": """
        SELECT * FROM corrections UNION ALL
        SELECT b.* FROM bars b WHERE NOT EXISTS (
            SELECT 1 FROM corrections c WHERE c.symbol = b.symbol AND c.date = b.date)""",
    "calendar": """
        SELECT DISTINCT CAST(l_shipdate AS DATE) AS session_date FROM lineitem
        WHERE isodow(l_shipdate) <= 5""",
    "landing": f"""
        SELECT symbol, CASE WHEN volume = 1 THEN 503 ELSE 200 END AS status_code,
               CASE volume WHEN 1 THEN repeat('server error ', 20)
                           WHEN 2 THEN '{{"empty":true,"candles":[]}}'
                           WHEN 3 THEN '{{"empty":false}}'
                           WHEN 10 THEN '<html>'
                           ELSE '{{"empty":false,"candles":[{{"datetime":86400000,"open":1,"high":1,'
                                || '"low":1,"close":1,"volume":1}},{{' || {_CANDLE} || '}}]}}' END
                   AS body,
               CAST(date_diff('day', DATE '1970-01-01', date) AS BIGINT) AS seq,
               CAST(date AS TIMESTAMP) + INTERVAL 1 DAY + INTERVAL 390 MINUTE
                   AS fetched_at
        FROM bars""",
    "parsed": """
        SELECT symbol, seq, status_code, body, fetched_at, NOT json_valid(body) AS unreadable,
               CASE WHEN json_valid(body) THEN
                   coalesce(json_extract_string(body, '$.empty') = 'true', false)
                   OR coalesce(json_array_length(body, '$.candles'), 0) = 0 ELSE true END
                   AS no_candles,
               CASE WHEN json_valid(body) THEN json_extract(body, '$.candles[#-1]') END AS candle
        FROM landing""",
    "candles": """
        SELECT symbol, seq, status_code, body, fetched_at, unreadable, no_candles, candle,
               CAST(epoch_ms(CAST(json_extract_string(candle, '$.datetime') AS BIGINT)) AS DATE)
                   AS date,
               """
    + ",\n               ".join(
        f"CAST(json_extract_string(candle, '$.{f}') AS DOUBLE) AS {f}" for f in FIELDS
    )
    + " FROM parsed",
    "prev_sessions": """
        SELECT d AS as_of, (SELECT max(session_date) FROM calendar
                            WHERE session_date < d AND session_date >= d - 10) AS prev_session
        FROM (SELECT DISTINCT CAST(fetched_at AS DATE) AS d FROM landing)""",
    "judged": """
        SELECT c.*, CASE
            WHEN status_code <> 200 OR unreadable OR no_candles THEN 'http'
            WHEN prev_session IS NULL OR date IS NULL OR date <> prev_session THEN 'session_date'
            WHEN open IS NULL OR open <= 0 OR high IS NULL OR high <= 0 OR low IS NULL
                 OR low <= 0 OR close IS NULL OR close <= 0 OR volume IS NULL OR volume <= 0
                 THEN 'positive'
            WHEN high < open OR high < close OR high < low OR low > open OR low > close
                 THEN 'ohlc' END AS gate,
            prev_session,
            CASE WHEN open IS NULL OR open <= 0 THEN 'open' WHEN high IS NULL OR high <= 0 THEN 'high'
                 WHEN low IS NULL OR low <= 0 THEN 'low' WHEN close IS NULL OR close <= 0 THEN 'close'
                 ELSE 'volume' END AS field
        FROM candles c LEFT JOIN prev_sessions p ON p.as_of = CAST(c.fetched_at AS DATE)""",
    "verdicts": """
        SELECT *, CASE WHEN gate = 'http' THEN 'HTTP_ERROR' WHEN gate IS NOT NULL THEN 'VALIDATION'
               END AS failure,
            symbol || ': ' || CASE gate
            WHEN 'http' THEN CASE
                WHEN status_code <> 200
                    THEN 'HTTP ' || status_code || ' — ' || substring(body, 1, 200)
                WHEN unreadable THEN 'unparseable response from vendor'
                ELSE 'empty response from vendor' END
            WHEN 'session_date' THEN 'candle date ' || coalesce(CAST(date AS VARCHAR), 'None')
                || ' != expected ' || coalesce(CAST(prev_session AS VARCHAR), 'None')
            WHEN 'positive' THEN 'field ''' || field || ''' missing or non-positive (got '
                || coalesce(json_extract_string(candle, '$.' || field), 'None') || ')'
            WHEN 'ohlc' THEN CASE WHEN high < open OR high < close OR high < low
                THEN 'high ' || high || ' does not dominate open=' || open || ' close=' || close
                     || ' low=' || low
                ELSE 'low ' || low || ' does not undercut open=' || open || ' close=' || close END
            END AS failure_error
        FROM judged""",
    "returns": _returns("bars"),
    "measured": _measured("returns"),
    "late": """
        SELECT * FROM verdicts
        WHERE seq >= date_diff('day', DATE '1970-01-01', DATE '2001-06-01')""",
    "late_bars": """
        SELECT symbol, date, open, high, low, close, CAST(trunc(volume) AS BIGINT) AS volume
        FROM late WHERE gate IS NULL""",
    "after_bars": """
        SELECT * FROM late_bars UNION ALL
        SELECT symbol, date, round(open * 100), round(high * 100), round(low * 100), round(close * 100),
               volume
        FROM bars WHERE date < DATE '2001-06-01'""",
    "after_returns": _returns("after_bars"),
    "after_measured": _measured("after_returns"),
    "late_measured": "SELECT * FROM after_measured WHERE date >= DATE '2001-06-01'",
    "listed": """
        SELECT DISTINCT symbol FROM universe_membership um JOIN membership m ON um.membership_id = m.id
        WHERE exit_date IS NULL""",
    "late_failed": _failed("late"),
    "after_dlq": f"""
        SELECT * FROM ({_dlq_after('late_failed')})
        WHERE symbol_id NOT IN (SELECT m.id FROM late_bars b JOIN membership m ON m.symbol = b.symbol)""",
    "after_counts": f"""
        SELECT (SELECT count(*) FROM late_bars) AS written,
               (SELECT nullif(count(*), 0) FROM listed) AS attempted,
               (SELECT count(*) FROM after_dlq WHERE created_at >= {NOW}) AS queued""",
    "last21": """
        SELECT symbol, date, close, volume, r FROM (
            SELECT *, ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS r,
                   row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth
            FROM (SELECT * FROM bars WHERE year(date) IN (2000, 2001))) WHERE nth <= 21""",
    "newest": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth
                       FROM measured) WHERE nth = 1""",
    "newest_events": """
        SELECT e.symbol, date, open, close, volume, prev_close,
               CASE WHEN m.id IS NOT NULL THEN 0.5 END AS rolling_sd,
               CASE WHEN m.id IS NOT NULL THEN CAST(length(e.symbol) AS DOUBLE) END
                   AS rolling_avg_volume
        FROM (SELECT *, CASE WHEN year(lag(date) OVER (PARTITION BY symbol ORDER BY date)) >= year(date) - 1
                         THEN lag(close) OVER (PARTITION BY symbol ORDER BY date) END AS prev_close,
                     row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth
              FROM event_bars) e
        LEFT JOIN membership m ON m.symbol = e.symbol WHERE nth = 1""",
    "places": """
        SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "tickers": """
        SELECT 'T.' || c_custkey AS ticker, r_name AS universe
        FROM customer JOIN places ON c_nationkey = n_nationkey
        UNION ALL
        SELECT 'T-' || c_custkey, r_name
        FROM customer JOIN places ON c_nationkey = n_nationkey WHERE c_acctbal < 0""",
    "membership": f"""
        SELECT {_id('membership', 'symbol')} AS id, symbol,
               {LISTED} AS created_at, {LISTED} AS updated_at
        FROM (SELECT 'T/' || s_suppkey AS symbol FROM supplier
              UNION SELECT 'T/' || c_custkey FROM customer WHERE c_acctbal < 0)""",
    "stints": f"""
        SELECT {_id('membership', 'symbol')} AS membership_id, universe_id, enter_date, exit_date
        FROM (
            SELECT 'T/' || s_suppkey AS symbol, r_name AS universe_id,
                   DATE '1998-01-01' AS enter_date, CAST(NULL AS DATE) AS exit_date
            FROM supplier JOIN places ON s_nationkey = n_nationkey
            UNION ALL
            SELECT 'T/' || s_suppkey, n_name, DATE '1998-01-01', NULL
            FROM supplier JOIN places ON s_nationkey = n_nationkey
            UNION ALL
            SELECT 'T/' || c_custkey, r_name, DATE '1995-01-02', DATE '1997-06-30'
            FROM customer JOIN places ON c_nationkey = n_nationkey WHERE c_acctbal < 0)""",
    "universe_membership": f"""
        SELECT {_id('universe_membership', 'membership_id', 'universe_id', 'CAST(enter_date AS VARCHAR)')}
                   AS id, membership_id, universe_id, enter_date, exit_date,
               {LISTED} AS created_at, {LISTED} AS updated_at, CAST(NULL AS VARCHAR) AS delisted_reason
        FROM stints""",
    "imported": """
        SELECT DISTINCT universe, regexp_replace(ticker, '[^a-zA-Z0-9\\s]', '/', 'g') AS symbol
        FROM tickers""",
    "active": """
        SELECT universe_id AS universe, symbol FROM universe_membership um
        JOIN membership m ON um.membership_id = m.id
        WHERE exit_date IS NULL AND universe_id IN (SELECT universe FROM imported)""",
    "added": "SELECT * FROM imported EXCEPT SELECT * FROM active",
    "dropped": "SELECT * FROM active EXCEPT SELECT * FROM imported",
    "membership_after": f"""
        SELECT * FROM membership UNION ALL
        SELECT {_id('membership', 'symbol')}, symbol, {NOW}, {NOW}
        FROM (SELECT DISTINCT symbol FROM added WHERE symbol NOT IN (SELECT symbol FROM membership))""",
    "relisted": f"""
        SELECT {_id('universe_membership', 'm.id', 'universe', "'2001-12-31'")} AS id,
               m.id AS membership_id, universe AS universe_id, {AS_OF} AS enter_date,
               CAST(NULL AS DATE) AS exit_date, {NOW} AS created_at, {NOW} AS updated_at,
               CAST(NULL AS VARCHAR) AS delisted_reason
        FROM added a JOIN membership_after m ON a.symbol = m.symbol""",
    "closed": f"""
        SELECT um.id, um.membership_id, um.universe_id, um.enter_date,
               CASE WHEN hit THEN {AS_OF} ELSE um.exit_date END AS exit_date, um.created_at,
               CASE WHEN hit THEN {NOW} ELSE um.updated_at END AS updated_at, um.delisted_reason
        FROM (SELECT u.*, u.exit_date IS NULL AND EXISTS (
                  SELECT 1 FROM dropped d JOIN membership m ON d.symbol = m.symbol
                  WHERE m.id = u.membership_id AND d.universe = u.universe_id) AS hit
              FROM universe_membership u) um""",
    "dlq": f"""
        SELECT {_id('failed_ingestion', 'symbol_id')} AS id, symbol_id, raw_symbol, created_at,
               'HTTP_ERROR' AS failure, 'earlier' AS failure_error,
               created_at + INTERVAL 1 HOUR AS retry_after, attempts, attempts >= 3 AS review_required
        FROM (SELECT {_id('membership', "'T/' || c_custkey")} AS symbol_id,
                     'T/' || c_custkey AS raw_symbol,
                     {LISTED} + to_days(CAST(c_nationkey AS INTEGER)) AS created_at,
                     c_nationkey AS attempts
              FROM customer WHERE c_acctbal < 0)""",
    "failed": _failed("verdicts"),
    "runs": f"""
        SELECT 'run-' || o_orderkey AS id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'prices' ELSE 'universes' END AS dag_id,
               CAST(o_orderdate AS DATE) AS run_date, 'RUNNING' AS status,
               CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR
                   + to_minutes(CAST(o_custkey AS INTEGER)) AS started_at,
               CAST(NULL AS TIMESTAMP) AS completed_at, 0 AS records_processed,
               0 AS records_failed, CAST(NULL AS VARCHAR) AS notes
        FROM orders""",
    "outcomes": """
        SELECT 'run-' || o_orderkey AS id, coalesce(w, 0) AS written,
               CASE WHEN o_orderstatus <> 'P' THEN a END AS attempted, coalesce(q, 0) AS queued
        FROM orders LEFT JOIN (
            SELECT l_orderkey, count(*) AS a, count(*) FILTER (l_returnflag <> 'R') AS w,
                   count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS q
            FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "run_errors": """
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'run-' || o_orderkey END AS id,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'prices' ELSE 'universes' END AS dag_id,
               CAST(o_orderdate AS DATE) AS run_date, 'failed at ' || o_orderkey AS error
        FROM orders WHERE o_orderstatus = 'F'""",
    "notes": """
        SELECT id, max(error) AS error FROM (
            SELECT id, error FROM run_errors WHERE id IS NOT NULL
            UNION ALL
            SELECT l.id, e.error FROM run_errors e JOIN (
                SELECT dag_id, run_date, last(id ORDER BY started_at, id) AS id
                FROM runs GROUP BY dag_id, run_date) l
            ON e.dag_id = l.dag_id AND e.run_date = l.run_date WHERE e.id IS NULL)
        GROUP BY id""",
}

_BAR = "symbol, date, open, high, low, close, volume"


def _annotated(source: str, log_sigma: float, gap_sigma: float, multiple: float) -> str:
    """The rules as SQL over rows that carry the baselines."""
    return f"""
        SELECT *, concat_ws(',',
            CASE WHEN abs(log_return) > log_return_limit THEN 'log_return' END,
            CASE WHEN abs(open_gap) > open_gap_limit THEN 'open_gap' END,
            CASE WHEN volume > volume_limit THEN 'volume_spike' END) AS rules
        FROM (SELECT *,
            CASE WHEN can THEN ln(close / prev_close) END AS log_return,
            CASE WHEN can THEN {log_sigma} * rolling_sd END AS log_return_limit,
            CASE WHEN can THEN ln(open / prev_close) END AS open_gap,
            CASE WHEN can THEN {gap_sigma} * rolling_sd END AS open_gap_limit,
            CASE WHEN vol THEN {multiple} * rolling_avg_volume END AS volume_limit,
            CAST(can AS INTEGER) + CAST(vol AS INTEGER) AS checks_run
        FROM (SELECT *, rolling_sd IS NOT NULL AND coalesce(prev_close, 0) > 0 AND open > 0 AS can,
                     coalesce(rolling_avg_volume, 0) > 0 AS vol FROM {source}))"""


_METRICS = "prev_close, " + ", ".join(
    f"round(CAST({name} AS DOUBLE), 6) AS {name}"
    for name in (
        "log_return", "log_return_limit", "open_gap", "open_gap_limit",
        "volume_limit", "rolling_sd", "rolling_avg_volume",
    )
)
_FLAGGED = f"symbol, date, rules, volume, checks_run, {_METRICS}"


def _flag_row(source: str, run_id: str) -> str:
    return f"""
        SELECT {_id('ohlcv_flag', 'm.id', 'CAST(date AS VARCHAR)')} AS id, m.id AS symbol_id,
               date AS session_date, '{run_id}' AS pipeline_run_id, rules, volume,
               {NOW} AS created_at, {_METRICS}
        FROM {source} a JOIN membership m ON m.symbol = a.symbol WHERE rules <> ''"""


def _gate(name: str) -> str:
    return f"SELECT symbol, seq, failure, failure_error FROM verdicts WHERE gate = '{name}'"


def _pages(source: str, member: str) -> str:
    return f"""
        SELECT universe, CAST(position // 25 AS BIGINT) AS page,
               max(size) AS group_size, string_agg({member}, ',' ORDER BY {member}) AS members
        FROM (SELECT universe, {member}, count(*) OVER (PARTITION BY universe) AS size,
                  row_number() OVER (
                      PARTITION BY universe ORDER BY md5({member}), {member}) - 1 AS position
              FROM (SELECT DISTINCT universe, {member} FROM {source}))
        GROUP BY universe, page"""


SQL = {
    "log_returns": "SELECT symbol, date, close, round(r, 6) AS log_return FROM returns",
    "recent_closes": "SELECT symbol, date, close, volume FROM last21",
    "rolling_stats": """
        SELECT symbol, round(stddev_samp(r) FILTER (nth <= 20), 6) AS rolling_sd,
               round(avg(CAST(volume AS DOUBLE)) FILTER (nth <= 20), 6) AS rolling_avg_volume
        FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth FROM last21)
        GROUP BY symbol HAVING count(*) >= 21""",
    "prices_of_symbols": f"""
        SELECT {_BAR}, CAST(year(date) AS INTEGER) AS year FROM bars WHERE symbol IN (
            SELECT m.symbol FROM universe_membership um JOIN membership m ON um.membership_id = m.id
            WHERE um.universe_id = 'NATION_3' AND um.exit_date IS NULL)""",
    "asof_close": """
        SELECT o_orderkey, symbol, date, CASE WHEN d >= date - 30 THEN d END AS matched_at,
               CASE WHEN d >= date - 30 THEN c END AS close
        FROM (SELECT o.o_orderkey, 'T/' || o.o_custkey AS symbol, CAST(o.o_orderdate AS DATE) AS date FROM orders o) o
        ASOF LEFT JOIN (SELECT symbol AS s, date AS d, close AS c FROM bars) b ON o.symbol = b.s AND o.date >= b.d""",
    "rejected_tickers": """
        SELECT 'T.' || c_custkey || ',SEA,x,y' AS line, count(*) AS rows FROM customer
        WHERE c_acctbal < 0 GROUP BY ALL""",
    "prev_close": """
        SELECT symbol, max(date) AS prev_date, last(close ORDER BY date) AS prev_close
        FROM bars WHERE date < DATE '2001-06-01' AND year(date) IN (2000, 2001) GROUP BY symbol""",
    "dedup_keep_last": """
        SELECT key, date, price, qty FROM (
            SELECT *, row_number() OVER (PARTITION BY key, date ORDER BY ord DESC) AS nth
            FROM ticks) WHERE nth = 1""",
    "price_upsert": f"SELECT {_BAR} FROM merged",
    "price_store": f"SELECT {_BAR}, CAST(year(date) AS INTEGER) AS year FROM merged",
    "flag_bars": f"SELECT {_FLAGGED} FROM ({_annotated('newest', 2.0, 1.5, 2.0)})",
    "flag_bars_stored": f"SELECT {_FLAGGED} FROM ({_annotated('newest_events', 2.0, 1.5, 2.0)})",
    "flag_history": f"SELECT {_FLAGGED} FROM ({_annotated('measured', 5.0, 3.0, 3.0)})",
    "flag_summary": f"""
        SELECT date, count(*) AS bars, count(*) FILTER (rules <> '') AS flagged,
               count(*) FILTER (checks_run = 0) AS unvalidated
        FROM ({_annotated('measured', 5.0, 3.0, 3.0)}) GROUP BY date""",
    "flag_replace": f"""
        SELECT * FROM ({_flag_row('(' + _annotated('measured', 5.0, 3.0, 3.0) + ')', 'earlier')})
        WHERE session_date < DATE '2000-01-01'
        UNION ALL BY NAME
        SELECT * FROM ({_flag_row('(' + _annotated('measured', 2.0, 1.5, 2.0) + ')', 'run-2002-01-01')})
        WHERE session_date >= DATE '2000-01-01'""",
    "volatility_upsert": f"""
        SELECT {_id('volatility_rolling', 'm.id')} AS id, m.id AS symbol_id,
               m.created_at, CASE WHEN n.symbol IS NULL THEN m.updated_at ELSE {NOW} END AS updated_at,
               round(coalesce(n.sd, 0.5), 6) AS rolling_sd,
               round(coalesce(n.av, CAST(length(m.symbol) AS DOUBLE)), 6) AS rolling_avg_volume
        FROM membership m LEFT JOIN (
            SELECT symbol, stddev_samp(r) FILTER (nth <= 20) AS sd,
                   avg(CAST(volume AS DOUBLE)) FILTER (nth <= 20) AS av
            FROM (SELECT *, ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS r,
                         row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth
                  FROM event_bars)
            GROUP BY symbol HAVING count(*) >= 21) n ON n.symbol = m.symbol""",
    "active_symbols": """
        SELECT DISTINCT symbol FROM universe_membership um JOIN membership m ON um.membership_id = m.id
        WHERE exit_date IS NULL""",
    "active_by_universe": "SELECT universe, symbol FROM active",
    "symbol_lookup": """
        SELECT b.symbol, m.id AS symbol_id, count(*) AS rows
        FROM event_bars b LEFT JOIN membership m ON m.symbol = b.symbol GROUP BY b.symbol, m.id""",
    "universe_diff": """
        SELECT universe, symbol, 'new' AS change FROM added
        UNION ALL SELECT universe, symbol, 'delisted' FROM dropped""",
    "membership_insert": "SELECT * FROM membership_after",
    "relist_insert": "SELECT * FROM universe_membership UNION ALL SELECT * FROM relisted",
    "close_membership": "SELECT * FROM closed",
    "weekly_run": "SELECT * FROM closed UNION ALL SELECT * FROM relisted",
    "daily_run": """
        SELECT symbol, date, open, high, low, close, CAST(trunc(volume) AS BIGINT) AS volume,
               CAST(year(date) AS INTEGER) AS year
        FROM verdicts WHERE gate IS NULL""",
    "tickers_by_universe": _pages("tickers", "ticker"),
    "delisting_report": f"""
        SELECT i.universe, coalesce(c.n, 0) AS delisted, coalesce(p.page, 0) AS page,
               coalesce(p.members, '') AS members
        FROM (SELECT DISTINCT universe FROM imported) i
        LEFT JOIN (SELECT universe, count(*) AS n FROM dropped GROUP BY universe) c
               ON c.universe = i.universe
        LEFT JOIN ({_pages('dropped', 'symbol')}) p ON p.universe = i.universe""",
    "scan_tickers": "SELECT ticker, universe FROM tickers",
    "symbol_batches": """
        SELECT symbol, CAST((row_number() OVER (ORDER BY md5(symbol), symbol) - 1) // 100 AS BIGINT)
               AS batch_id
        FROM (SELECT DISTINCT symbol FROM universe_membership um
              JOIN membership m ON um.membership_id = m.id WHERE exit_date IS NULL)""",
    "parse_candles": """
        SELECT symbol, seq, status_code, unreadable, no_candles, date, open, high, low, close, volume
        FROM candles""",
    "gate_http": _gate("http"),
    "gate_session_date": _gate("session_date"),
    "gate_positive": _gate("positive"),
    "gate_ohlc": _gate("ohlc"),
    "ingest_gate": """
        SELECT symbol, seq, date, open, high, low, close, volume, gate, failure, failure_error
        FROM verdicts""",
    "prev_session": """
        SELECT d AS as_of, (SELECT max(session_date) FROM calendar
                            WHERE session_date < d AND session_date >= d - 10) AS prev_session,
               orders
        FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders FROM orders GROUP BY 1)""",
    "union_chunks": f"""
        SELECT {_BAR} FROM (SELECT * FROM bars UNION ALL SELECT * FROM event_bars)""",
    "dlq_upsert": _dlq_after("failed"),
    "dlq_clear": """
        SELECT * FROM dlq WHERE symbol_id NOT IN (
            SELECT m.id FROM membership m JOIN bars b ON b.symbol = m.symbol)""",
    "dlq_count_since": """
        SELECT count(*) AS failures FROM dlq WHERE created_at >= TIMESTAMP '1995-01-13 00:00:00'""",
    "run_status": f"""
        SELECT r.id, dag_id, run_date, started_at, {NOW} AS completed_at, notes,
               CASE WHEN written = 0 THEN 'FAILED'
                    WHEN attempted IS NULL THEN CASE WHEN queued = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END
                    WHEN written < attempted OR queued > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
               CAST(written AS INTEGER) AS records_processed,
               CAST(CASE WHEN attempted IS NULL THEN queued
                    ELSE greatest(attempted - written, 0) END AS INTEGER) AS records_failed,
               attempted IS NOT NULL AND greatest(attempted - written, 0) <> queued AS dlq_mismatch
        FROM runs r JOIN outcomes o ON r.id = o.id""",
    "run_failed": f"""
        SELECT r.id, dag_id, run_date, CASE WHEN n.id IS NULL THEN status ELSE 'FAILED' END AS status,
               started_at, CASE WHEN n.id IS NULL THEN completed_at ELSE {NOW} END AS completed_at,
               records_processed, records_failed, coalesce(n.error, notes) AS notes
        FROM runs r LEFT JOIN notes n ON n.id = r.id""",
    "latest_runs": "SELECT * FROM runs ORDER BY started_at DESC, id DESC LIMIT 5",
    "weekly_membership": "SELECT * FROM membership_after",
    "daily_flags": f"""
        SELECT * FROM ({_flag_row('(' + _annotated('late_measured', 2.0, 1.5, 2.0) + ')', 'run-2002-01-01')})""",
    "daily_dlq": "SELECT * FROM after_dlq",
    "daily_baselines": f"""
        SELECT {_id('volatility_rolling', 'm.id')} AS id, m.id AS symbol_id,
               m.created_at, CASE WHEN n.symbol IS NULL THEN m.updated_at ELSE {NOW} END AS updated_at,
               round(coalesce(n.sd, 0.5), 6) AS rolling_sd,
               round(coalesce(n.av, CAST(length(m.symbol) AS DOUBLE)), 6) AS rolling_avg_volume
        FROM membership m LEFT JOIN (
            SELECT symbol, stddev_samp(r) FILTER (nth <= 20) AS sd,
                   avg(CAST(volume AS DOUBLE)) FILTER (nth <= 20) AS av
            FROM (SELECT *, ln(close) - ln(lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS r,
                         row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS nth
                  FROM after_bars WHERE year(date) IN (2000, 2001))
            WHERE nth <= 21 AND symbol IN (SELECT symbol FROM listed)
            GROUP BY symbol HAVING count(*) >= 21) n ON n.symbol = m.symbol""",
    "daily_log": f"""
        SELECT 'run-2002-01-01' AS id, 'prices_daily' AS dag_id, {AS_OF} AS run_date,
               CASE WHEN written = 0 THEN 'FAILED'
                    WHEN attempted IS NULL THEN CASE WHEN queued = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END
                    WHEN written < attempted OR queued > 0 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status,
               {NOW} AS started_at, {NOW} AS completed_at,
               CAST(written AS INTEGER) AS records_processed,
               CAST(CASE WHEN attempted IS NULL THEN queued
                    ELSE greatest(attempted - written, 0) END AS INTEGER) AS records_failed,
               CAST(NULL AS VARCHAR) AS notes
        FROM after_counts""",
    "daily_report": f"""
        SELECT 'run-2002-01-01' AS id,
               (SELECT count(*) FROM ({_annotated('late_measured', 2.0, 1.5, 2.0)}) WHERE rules <> '')
                   AS flagged,
               (SELECT count(*) FROM ({_annotated('late_measured', 2.0, 1.5, 2.0)}) WHERE checks_run = 0)
                   AS unvalidated,
               (SELECT count(*) FROM late_bars WHERE symbol NOT IN (SELECT symbol FROM membership))
                   AS unknown_bars,
               CAST(0 AS BIGINT) AS duplicate_bars,
               attempted IS NOT NULL AND greatest(attempted - written, 0) <> queued AS dlq_mismatch
        FROM after_counts""",
    "failure_list": """
        SELECT raw_symbol, failure, attempts FROM after_dlq
        WHERE review_required AND attempts >= 3 ORDER BY attempts DESC, raw_symbol""",
    "sql_prices": """
        SELECT symbol, count(*) AS bars, max(close) AS top FROM after_bars
        WHERE date >= DATE '2001-01-01' GROUP BY symbol""",
    "run_start": f"""
        SELECT * FROM runs UNION ALL
        SELECT 'run-2002-01-01', 'prices_daily', {AS_OF}, 'RUNNING', {NOW}, NULL, 0, 0, NULL""",
    "keyed_upsert": """
        SELECT coalesce(b.symbol, c.symbol) AS symbol, coalesce(b.date, c.date) AS date,
               coalesce(b.open, c.open) AS open, coalesce(b.high, c.high) AS high,
               coalesce(b.low, c.low) AS low, coalesce(c.close, b.close) AS close,
               CAST(coalesce(b.volume, 0) + coalesce(c.volume, 0) AS BIGINT) AS volume
        FROM bars b FULL JOIN corrections c ON b.symbol = c.symbol AND b.date = c.date""",
    "merge_refused": """
        SELECT key, date, count(*) AS copies FROM ticks GROUP BY key, date HAVING count(*) > 1""",
    "price_store_retry": f"SELECT {_BAR}, CAST(year(date) AS INTEGER) AS year FROM merged",
    "audit_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "audit_active_unique": """
        SELECT o_custkey AS membership_id, o_orderpriority AS universe_id, count(*) AS copies
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey, o_orderpriority
        HAVING count(*) > 1""",
    "audit_values": """
        SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS rows FROM orders
        WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY o_orderstatus""",
    "audit_fk": """
        SELECT user_id AS value, count(*) AS rows FROM events
        WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY user_id""",
    "audit_required": """
        SELECT o_orderkey, 'l_orderkey is null' AS violation FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        UNION ALL
        SELECT o_orderkey, 'o_orderpriority is longer than 8' FROM orders
        WHERE length(o_orderpriority) > 8""",
    "retention_purge": """
        SELECT event_id, ts FROM events WHERE ts >= DATE '2024-02-15' - INTERVAL 30 DAY""",
    "compact_prices": f"""
        SELECT {_BAR}, CAST(year(date) AS INTEGER) AS year
        FROM (SELECT * FROM bars UNION ALL SELECT * FROM event_bars)""",
    "orphan_files": """
        SELECT DISTINCT 1 AS version, CAST(year(date) AS INTEGER) AS year FROM returned_bars""",
}


SQL["baseline_merge"] = SQL["rolling_stats"]
SQL["history_bucketed"] = SQL["flag_history"]
SQL["universe_digest_diff"] = SQL["universe_diff"]


def _needed(text: str, found: list[str]) -> None:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+\(?{name}\b", text):
            _needed(body, found)
            found.append(name)


def statements() -> dict[str, str]:
    """Complete SQL per query."""
    complete = {}
    for name, text in SQL.items():
        views: list[str] = []
        _needed(text, views)
        prelude = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in views)
        complete[name] = f"WITH {prelude}\n{text}" if views else text
    return complete
