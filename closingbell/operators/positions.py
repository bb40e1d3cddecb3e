"""Row numbers and bounded lists over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# 16^4 buckets per group: a billion members leave about 15,000 rows to a bucket.
DIGITS = 4


def number_rows(
    df: DataFrame, group: list[str], member: str, digits: int = DIGITS
) -> DataFrame:
    """``position`` 0.. of every row in its group, in digest order of ``member``, and the
    ``group_size``.

    The group is cut into buckets by the leading digits of the member's digest; rows are
    numbered inside a bucket, and a bucket starts where the counts of the buckets before
    it end. So no task sees a whole group: the only window over a group runs over at most
    16^digits counts. ``member`` must be unique in its group, and the numbering depends on
    the data alone, so a retried task gives the same numbers.
    """
    placed = df.withColumn("__digest", F.md5(F.col(member))).withColumn(
        "__bucket", F.substring("__digest", 1, digits)
    )
    bucket = [*group, "__bucket"]
    before = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        placed.groupBy(*bucket)
        .agg(F.count("*").alias("__rows"))
        .select(
            *bucket,
            F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
            F.sum("__rows").over(Window.partitionBy(*group)).alias("group_size"),
        )
    )
    inside = Window.partitionBy(*bucket).orderBy("__digest", member)
    return (
        placed.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(starts, bucket)
        .select(
            *df.columns, (F.col("__start") + F.col("__rank")).alias("position"), "group_size"
        )
    )


def paged_lists(
    df: DataFrame, group: list[str], member: str, page_size: int, digits: int = DIGITS
) -> DataFrame:
    """Group members as lists of at most ``page_size``; a group of any size stays whole
    over its pages, and no list grows with the data. Each page carries the ``group_size``."""
    return (
        number_rows(df.select(*group, member), group, member, digits)
        .withColumn("page", F.floor(F.col("position") / page_size).cast("bigint"))
        .groupBy(*group, "page")
        .agg(
            F.max("group_size").alias("group_size"),
            F.sort_array(F.collect_list(member)).alias("members"),
        )
    )
