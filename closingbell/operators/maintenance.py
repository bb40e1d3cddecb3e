"""Upkeep of the stored files: compaction, unreferenced files, retention."""

from __future__ import annotations

import datetime as dt
import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import accumulate, batched
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from closingbell.functions.dates import as_date
from closingbell.sources import prices
from closingbell.sources.years import YearTable

# Retention of unreferenced files, retention of dated rows.
RETENTION_HOURS = 168
PURGE_DAYS = 30


FILES = "path string, bytes bigint, modified timestamp"


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, bytes, modified)`` of the data files under some folders, without reading them."""
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
    )
    try:
        found = reader.load(list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and len(paths) == 1:
            return spark.createDataFrame([], FILES)
        raise
    return found.select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )


def year_files(table: YearTable) -> DataFrame:
    """Files and bytes per year of a table."""
    if not table.versions:
        return table.spark.createDataFrame([], "year int, files bigint, bytes bigint")
    year = F.regexp_extract("path", r"/year=(\d+)/", 1).cast("int")
    return (
        list_files(table.spark, *table.paths())
        .groupBy(year.alias("year"))
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )


def compact_prices(table: YearTable, target_bytes: int = prices.TARGET_BYTES) -> DataFrame:
    """Repack the years that hold more files than their bytes need; bars are unchanged.

    A repacked year is the next version of it, and counts if it has as many bars. A year gets as
    many files as its bytes need, each with the bars of some symbols, so a second compaction finds
    nothing to pack. Returns files and bytes before and after.
    """
    # one row per year
    stats = year_files(table).collect()
    wanted = {s.year: max(1, math.ceil(s.bytes / target_bytes)) for s in stats}
    packed = [s.year for s in stats if s.files > wanted[s.year]]
    if packed:
        live = table.read(packed)
        # a partition for each file; one row per year in the lists
        begins = dict(zip(packed, accumulate((wanted[year] for year in packed), initial=0)))
        own = F.lit(0)
        for year in packed:
            place = F.pmod(F.xxhash64("symbol"), F.lit(wanted[year])) + begins[year]
            own = F.when(F.col("year") == year, place).otherwise(own)
        files = sum(wanted[year] for year in packed)
        table.replace(live.repartitionById(files, own.cast("int")), packed, live.count(), dealt=True)
    was = table.spark.createDataFrame(
        [(s.year, s.files, s.bytes) for s in stats],
        "year int, files_before bigint, bytes_before bigint",
    )
    return was.join(year_files(table), "year", "left").select(
        "year",
        "files_before",
        F.col("files").alias("files_after"),
        "bytes_before",
        F.col("bytes").alias("bytes_after"),
    )


def orphan_files(
    spark: SparkSession,
    root: str,
    live: list[str],
    as_of: dt.datetime,
    retention_hours: int = RETENTION_HOURS,
    allow_short: bool = False,
) -> DataFrame:
    """Files under ``root`` that no live folder holds and that are past the retention.

    This only lists them; deleting is the caller's separate step. Less than the floor of
    168 hours must be asked for, as a reader may still be on such a file.
    """
    if retention_hours < RETENTION_HOURS and not allow_short:
        raise ValueError(f"retention below {RETENTION_HOURS} h needs allow_short=True")
    limit = F.lit(as_of - dt.timedelta(hours=retention_hours)).cast("timestamp")
    folders = [F.col("path").contains(f"{urlsplit(path).path}/") for path in live]
    held = reduce(lambda a, b: a | b, folders, F.lit(False))
    return list_files(spark, root).filter(~held & (F.col("modified") < limit))


def remove_files(spark: SparkSession, files: DataFrame, at_once: int = 32) -> int:
    """Delete listed files through the cluster's file system; returns how many went.

    The list is a stored table (a listing planned anew would change while files go). It
    reaches the driver a partition at a time; only file system calls are made there.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    settings = spark.sparkContext._jsc.hadoopConfiguration()

    def remove(row) -> bool:
        path = hadoop.Path(row.path)
        return path.getFileSystem(settings).delete(path, False)

    removed = 0
    with ThreadPoolExecutor(at_once) as pool:
        for some in batched(files.select("path").toLocalIterator(), 1000):
            removed += sum(pool.map(remove, some))
    return removed


def retention_purge(df: DataFrame, column: str, as_of, days: int = PURGE_DAYS) -> DataFrame:
    """Rows that stay: not older than ``days`` before midnight of the run's own date."""
    boundary = F.date_sub(as_date(as_of), days).cast("timestamp_ntz")
    return df.filter(F.col(column) >= boundary)
