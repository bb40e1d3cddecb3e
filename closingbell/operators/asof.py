"""As-of join: every row with the newest match before it, for keys and times of any crowding.

Both sides are put in one order per key and period (a calendar month). Inside a period the last
match is carried along; across periods only each period's last match is carried, one row per
key and period. So no task holds a key's whole history, and a time that very many rows share is
looked up once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    at: str,
    strict: bool = False,
    tolerance: Column | None = None,
) -> DataFrame:
    """``left`` with the columns of the newest ``right`` row of its key at or before its time.

    ``at`` is a date or timestamp on both sides. ``strict`` leaves out matches at the very time,
    ``tolerance`` (an interval) those that are older. Rows of ``right`` are unique on key and time;
    its time comes back as ``matched_at``. A left row without a match, or with a null key or time, has nulls.
    """
    values = [c for c in right.columns if c not in (*by, at)]
    clash = [c for c in (*values, "matched_at") if c in left.columns]
    if clash:
        raise ValueError(f"both sides have the columns {clash}")
    found = F.struct(F.col(at).alias("matched_at"), *values).alias("__match")
    asked = left.select(*by, at).dropna().distinct()
    # at equal times what is asked comes behind the match, or before it
    spots = asked.select(*by, at, F.lit(not strict).alias("__behind"), F.lit(None).alias("__match")).unionByName(
        right.dropna(subset=[*by, at]).select(*by, at, F.lit(strict).alias("__behind"), found)
    ).withColumn("__period", F.date_trunc("month", F.col(at)))
    inside = Window.partitionBy(*by, "__period").orderBy(at, "__behind")
    periods = spots.groupBy(*by, "__period").agg(F.max("__match").alias("__last"))
    before = Window.partitionBy(*by).orderBy("__period").rowsBetween(Window.unboundedPreceding, -1)
    carried = periods.select(*by, "__period", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    mine = F.last("__match", ignorenulls=True).over(inside)
    matched = spots.withColumn("__mine", mine).filter(F.col("__match").isNull())
    matched = matched.join(carried, [*by, "__period"])
    match = F.coalesce("__mine", "__carried")
    if tolerance is not None:
        match = F.when(match["matched_at"] >= F.col(at) - tolerance, match)
    matched = matched.select(*by, at, match.alias("__match"))
    return left.join(matched, [*by, at], "left").select(
        *(left[c] for c in left.columns), "__match.matched_at", *(F.col(f"__match.{c}").alias(c) for c in values)
    )
