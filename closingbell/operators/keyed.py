"""Keyed changes to a stored table, as set operations that return its next version.

``changes`` must be unique on its key (``require_unique``), which is what a MERGE asks of
its source. The joins carry no broadcast hint: a day's batch is small next to a store, but
nothing bounds it, so adaptive execution decides from the measured size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

SPREAD = 64


class DuplicateKeys(ValueError):
    """A source of keyed changes holds the same key twice."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row; copies are counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def require_unique(df: DataFrame, keys: list[str]) -> None:
    if duplicate_keys(df, keys).limit(1).count():
        raise DuplicateKeys(f"rows are not unique on {keys}")


def replace_rows(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Matched rows are replaced whole, unmatched ones added. Idempotent."""
    kept = target.join(changes.select(*keys), keys, "left_anti")
    return kept.unionByName(changes.select(*target.columns))


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    update: Mapping[str, Column],
) -> DataFrame:
    """Insert new keys whole; on a known key change only the columns named in ``update``.

    Expressions in ``update`` see the stored row as ``old.*`` and the change as ``new.*``.
    Rows whose key is not among the changes stay as they are. Keys are unique on both
    sides, so no key can crowd the join.
    """
    matched = F.col("old.__stored") & F.col("new.__changed")
    old = target.withColumn("__stored", F.lit(True)).alias("old")
    new = changes.withColumn("__changed", F.lit(True)).alias("new")
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    columns = []
    for name in target.columns:
        stored, incoming = F.col(f"old.{name}"), F.col(f"new.{name}")
        value = F.when(F.col("old.__stored"), stored).otherwise(incoming)
        if name in update:
            value = F.when(matched, update[name]).otherwise(value)
        columns.append(value.cast(target.schema[name].dataType).alias(name))
    return old.join(new, same_key, "full_outer").select(*columns)


def absent_rows(
    target: DataFrame, rows: DataFrame, keys: list[str], among: str | None = None
) -> DataFrame:
    """Rows whose key is not stored yet, once per key; ``among`` limits the stored rows
    that count (a partial unique key)."""
    known = target.filter(among) if among else target
    return rows.dropDuplicates(keys).join(known.select(*keys), keys, "left_anti")


def insert_absent(
    target: DataFrame, rows: DataFrame, keys: list[str], among: str | None = None
) -> DataFrame:
    """The table with its absent rows added; stored rows are untouched."""
    fresh = absent_rows(target, rows, keys, among)
    return target.unionByName(fresh.select(*target.columns))


def replace_slice(
    target: DataFrame, evaluated: DataFrame, rows: DataFrame, keys: list[str]
) -> DataFrame:
    """Everything stored under an evaluated key goes; the evaluation's rows come in."""
    return delete_matching(target, evaluated, keys).unionByName(rows.select(*target.columns))


def delete_matching(target: DataFrame, matched: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(matched.select(*keys).distinct(), keys, "left_anti")


def keep_listed(
    rows: DataFrame, listed: DataFrame, keys: list[str], spread_by: list[str]
) -> DataFrame:
    """Rows whose key is listed, for a key that very many rows share.

    The rows of one key are spread over ``SPREAD`` sub-keys by a hash of other columns, and
    each listed key (distinct first) is repeated for every sub-key. Exact, and no task gets
    all rows of a key.
    """
    spread = rows.withColumn("__sub", F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)))
    wanted = listed.select(*keys).distinct().withColumn(
        "__sub", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint")))
    )
    return spread.join(wanted, [*keys, "__sub"], "left_semi").drop("__sub")


def update_matching(
    target: DataFrame,
    matched: DataFrame,
    keys: list[str],
    update: Mapping[str, Column],
    where: Column | None = None,
) -> DataFrame:
    """Set columns on stored rows whose key is listed (and that meet ``where``)."""
    listed = matched.select(*keys).distinct().withColumn("__listed", F.lit(True))
    hit = F.coalesce(F.col("__listed"), F.lit(False))
    if where is not None:
        hit = hit & where
    joined = target.join(listed, keys, "left")
    return joined.select(
        *[
            (F.when(hit, update[name]).otherwise(F.col(name)) if name in update else F.col(name))
            .cast(target.schema[name].dataType)
            .alias(name)
            for name in target.columns
        ]
    )
