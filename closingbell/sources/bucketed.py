"""Prices laid out for windows: buckets by symbol, sorted by date.

What reads whole histories of symbols (returns, baselines, annotation) then needs no shuffle, and
a join on the symbol moves the other side alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_bucketed(bars: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """The bars as the catalog's table ``name`` under ``path``; the number of buckets should follow
    the bytes (128 MB to a bucket or so)."""
    (
        # one file for each bucket
        bars.repartition(buckets, "symbol")
        .write.mode("overwrite")
        .bucketBy(buckets, "symbol")
        .sortBy("symbol", "date")
        .option("path", path)
        .saveAsTable(name)
    )
    return bars.sparkSession.table(name)
