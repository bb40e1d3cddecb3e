"""Integrity rules as violation queries: an empty result means the rule holds.

Every audit folds its rows by the audited value before the shuffle, so a value that most
rows share is one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from closingbell import schemas
from closingbell.operators.keyed import duplicate_keys


def audit_unique(df: DataFrame, keys: Sequence[str], where: str | None = None) -> DataFrame:
    """Keys held more than once, null keys aside; ``where`` makes it a partial key."""
    rows = df.filter(where) if where else df
    return duplicate_keys(rows.dropna(subset=list(keys)), list(keys))


def audit_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the accepted list. Null passes, as it does in a CHECK."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
        .select(F.lit(column).alias("column"), "value", "rows")
    )


def audit_fk(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child values without a parent, with the number of rows that hold them."""
    return (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("rows"))
        .join(parent.select(F.col(parent_key).alias("value")), "value", "left_anti")
    )


def audit_required(
    df: DataFrame,
    key: Sequence[str],
    required: Sequence[str],
    max_length: Mapping[str, int],
) -> DataFrame:
    """One row per violating row and rule: a null that must not be, a text that is too long."""
    rules = [
        F.when(F.col(name).isNull(), F.lit(f"{name} is null")) for name in required
    ] + [
        F.when(F.length(name) > n, F.lit(f"{name} is longer than {n}"))
        for name, n in max_length.items()
    ]
    return df.select(
        *key, F.explode(F.array_compact(F.array(*rules))).alias("violation")
    )


def audit_table(tables: Mapping[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Every rule the schema states for one table, by rule name."""
    df = tables[name]
    found = {}
    if name in schemas.UNIQUE_KEYS:
        found["unique"] = audit_unique(df, schemas.UNIQUE_KEYS[name])
    if name in schemas.ACTIVE_KEYS:
        found["active_unique"] = audit_unique(df, schemas.ACTIVE_KEYS[name], "exit_date IS NULL")
    for column, accepted in schemas.ACCEPTED_VALUES.get(name, {}).items():
        found[f"values:{column}"] = audit_values(df, column, accepted)
    for column, parent, parent_key in schemas.FOREIGN_KEYS.get(name, []):
        if parent in tables:
            found[f"fk:{column}"] = audit_fk(df, column, tables[parent], parent_key)
    required = schemas.NOT_NULL.get(name, [])
    lengths = schemas.MAX_LENGTH.get(name, {})
    if required or lengths:
        key = ["id"] if "id" in df.columns else schemas.UNIQUE_KEYS[name]
        found["required"] = audit_required(df, key, required, lengths)
    return found


def violations(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    """``(table, rule, violations)`` of one table, one row per rule.

    All rules in one pass: a row gives one mark for every rule that has to see it, parents give the
    keys that exist, and one aggregation over (rule, mark) answers them all. Marks are counted
    before the shuffle, so a key that most rows share is one row per map task.
    """
    df = tables[name]
    marks, known = [], []

    def mark(rule: str, value: Column, where: Column) -> None:
        marks.append(F.when(where, F.struct(F.lit(rule).alias("rule"), value.alias("mark"))))

    def unique(rule: str, keys: Sequence[str], where: Column = F.lit(True)) -> None:
        whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
        mark(rule, F.to_json(F.struct(*keys)), whole & where)

    if name in schemas.UNIQUE_KEYS:
        unique("unique", schemas.UNIQUE_KEYS[name])
    if name in schemas.ACTIVE_KEYS:
        unique("active_unique", schemas.ACTIVE_KEYS[name], F.expr("exit_date IS NULL"))
    for column, accepted in schemas.ACCEPTED_VALUES.get(name, {}).items():
        mark(f"values:{column}", F.col(column).cast("string"), F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
    for column, parent, parent_key in schemas.FOREIGN_KEYS.get(name, []):
        if parent in tables:
            rule = f"fk:{column}"
            mark(rule, F.col(column).cast("string"), F.col(column).isNotNull())
            keys = tables[parent].select(F.lit(rule).alias("rule"), F.col(parent_key).cast("string").alias("mark"))
            known.append(keys.withColumn("child", F.lit(0)))
    required = schemas.NOT_NULL.get(name, [])
    lengths = schemas.MAX_LENGTH.get(name, {})
    for column in required:
        mark("required", F.lit(f"{column} is null"), F.col(column).isNull())
    for column, most in lengths.items():
        mark("required", F.lit(f"{column} is longer than {most}"), F.length(column) > most)

    made = df.select(F.explode(F.array_compact(F.array(*marks))).alias("m")).select("m.*", F.lit(1).alias("child"))
    folded = reduce(lambda a, b: a.unionByName(b), known, made).groupBy("rule", "mark").agg(
        F.sum("child").alias("rows"), F.min("child").alias("orphan")
    )
    rule = F.col("rule")
    bad = (
        F.when(rule == "required", F.col("rows"))
        .when(rule.endswith("unique"), (F.col("rows") > 1).cast("bigint"))
        .when(rule.startswith("fk:"), F.col("orphan").cast("bigint"))
        .otherwise(F.lit(1).cast("bigint"))
    )
    counted = folded.groupBy("rule").agg(F.sum(bad).alias("violations"))
    rules = ["unique"] * (name in schemas.UNIQUE_KEYS) + ["active_unique"] * (name in schemas.ACTIVE_KEYS)
    rules += [f"values:{c}" for c in schemas.ACCEPTED_VALUES.get(name, {})]
    rules += [f"fk:{c}" for c, parent, _ in schemas.FOREIGN_KEYS.get(name, []) if parent in tables]
    rules += ["required"] * bool(required or lengths)
    listed = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, rules))).alias("rule"))
    return listed.join(counted, "rule", "left").select(
        F.lit(name).alias("table"), "rule", F.coalesce("violations", F.lit(0)).alias("violations")
    )
