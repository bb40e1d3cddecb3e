"""Run a registered query and its SQL twin, and compare them as the driver does."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _bag(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def mismatch(con, result, sql: str) -> str | None:
    """None when both sides agree; else what differs."""
    spark_columns, spark_rows = _bag(result.columns, [tuple(r) for r in result.collect()])
    cursor = con.execute(sql)
    sql_columns, sql_rows = _bag([d[0] for d in cursor.description], cursor.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} vs {sql_columns}"
    if spark_rows != sql_rows:
        return (
            f"rows {sum(spark_rows.values())} vs {sum(sql_rows.values())}; "
            f"only spark {list((spark_rows - sql_rows).items())[:3]}; "
            f"only sql {list((sql_rows - spark_rows).items())[:3]}; {spark_columns}"
        )
    if not spark_rows:
        return "both results are empty"
    kinds = [
        [sorted({type(v).__name__ for row in bag for v in [row[i]] if v is not None})
         for i in range(len(spark_columns))]
        for bag in (spark_rows, sql_rows)
    ]
    return None if kinds[0] == kinds[1] else f"types {kinds}"


def main() -> None:
    import __spark_entry__ as entry
    from closingbell.session import build

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    statements = entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        began = time.time()
        try:
            found = mismatch(con, query(spark, sf_dir), statements[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{name:22s} {time.time() - began:6.2f}s {'ok' if found is None else found}", flush=True)


if __name__ == "__main__":
    main()
