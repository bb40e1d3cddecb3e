"""Ticker snapshot files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from closingbell import schemas


class TickersMissing(FileNotFoundError):
    """There is no snapshot file; a file that cannot be parsed fails as Spark's own error."""


REJECTED = "rejected"


def _reader(spark: SparkSession, path: str):
    """A CSV reader and the columns of the snapshot.

    Columns are found by header name, all strings. Every file's own header is held against the
    first one's, so a file with other columns or another order fails instead of being read by
    position. Quoted values may hold line breaks; a snapshot is small, so its files need not be
    split.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("multiLine", True)
    )
    try:
        names = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TickersMissing(path) from error
        raise
    absent = [name for name in schemas.TICKERS.names if name not in names]
    if absent:
        raise ValueError(f"snapshot {path} has no column {absent}")
    return reader, names


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot rows and, in ``rejected``, a line that does not fit the header."""
    reader, names = _reader(spark, path)
    schema = StructType([StructField(name, StringType()) for name in [*names, REJECTED]])
    return reader.option("columnNameOfCorruptRecord", REJECTED).schema(schema).csv(path)


def scan_tickers(spark: SparkSession, path: str, keep_rest: bool = False) -> DataFrame:
    """Snapshot rows ``(ticker, universe)``, nulls as empty strings.

    A line that does not fit the header fails the scan: left out of a snapshot, its symbol would
    count as delisted. With ``keep_rest`` the other lines are returned, and ``rejected_lines`` has
    those that were left out.
    """
    if keep_rest:
        rows = _parsed(spark, path).filter(F.col(REJECTED).isNull())
    else:
        rows = _reader(spark, path)[0].option("mode", "FAILFAST").csv(path)
    return rows.select(*schemas.TICKERS.names).na.fill("")


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, rows)``: what ``scan_tickers`` leaves out, each line with how often it came."""
    rows = _parsed(spark, path).filter(F.col(REJECTED).isNotNull())
    # Spark wants a parsed column beside the line
    seen = F.count(F.coalesce("ticker", "universe", REJECTED))
    return rows.groupBy(F.col(REJECTED).alias("line")).agg(seen.alias("rows"))
