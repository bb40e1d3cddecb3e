"""The price store: Parquet by year, keyed on (symbol, date).

A batch is merged by plain jobs: bars that are new to a year are appended to it, and a year in which a
stored bar changes is written anew, once, beside the folder that counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closingbell import schemas
from closingbell.functions import session_year
from closingbell.operators import keyed
from closingbell.sources.years import YearTable

KEY = ["symbol", "date"]
VALUES = ["open", "high", "low", "close", "volume"]

# Fixed value: size of a compacted file.
TARGET_BYTES = 256 * 1024 * 1024
# Fixed value: symbols that are given to a scan by name.
SHORT_LIST = 1000
# Bars of a batch from which it is probed, and the part of the symbols that is looked at.
PROBE_FROM = 500_000
PROBE_PART = 64


def price_table(spark: SparkSession, root: str, versions: dict[int, int] | None = None) -> YearTable:
    return YearTable(spark, root, schemas.PRICES, KEY, versions)


def with_year(bars: DataFrame) -> DataFrame:
    return bars.withColumn("year", session_year(F.col("date"))).select(*schemas.PRICES.names)


def of_symbols(rows: DataFrame, listed: DataFrame, most: int = SHORT_LIST) -> DataFrame:
    """The rows of listed symbols. A short list becomes a filter that reaches the scan, where sorted
    files let it skip row groups; a longer one is a join."""
    names = [row.symbol for row in listed.select("symbol").distinct().limit(most + 1).collect()]
    if len(names) <= most:
        return rows.filter(F.col("symbol").isin(names))
    return rows.join(listed.select("symbol").distinct(), "symbol", "left_semi")


def merge_bars(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The table's next content: batch bars replace or join the stored ones."""
    return keyed.replace_rows(target, batch, KEY)


def upsert_prices(table: YearTable, batch: DataFrame) -> int:
    """Merge a batch into the table; returns the number of bars in it.

    A daily batch seldom meets a stored bar: then it is appended and nothing is rewritten.
    A batch that comes again as it was (a retried run) finds its bars stored and only adds
    those that are missing. A comparison and a write shuffle the rows once each, and tell on the
    way whether the batch is unique; nothing counts before all of it is known. The first batch of
    a table is read once, a later one some times: one that is costly to derive should be stored.
    """
    incoming = with_year(batch)
    if not table.versions:
        return table.fill(incoming)
    # one row per year of the batch here and below: bounded by the calendar
    spans = {
        row.year: row
        for row in incoming.groupBy("year")
        .agg(F.count(F.lit(1)).alias("bars"), F.min("date").alias("first"), F.max("date").alias("last"))
        .collect()
    }
    total = sum(span.bars for span in spans.values())
    if None in spans and not keyed.duplicate_keys(incoming.filter("year IS NULL"), KEY).isEmpty():
        raise _not_unique()
    new = [year for year in spans if year is not None and year not in table.versions]
    known = [year for year in spans if year in table.versions]

    meeting = incoming.filter(F.col("year").isin(known))
    reached = table.read(known)
    if known:
        reached = reached.filter(
            F.col("date").between(
                min(spans[year].first for year in known), max(spans[year].last for year in known)
            )
        )
    changed = []
    if sum(spans[year].bars for year in known) >= PROBE_FROM:
        changed = [row.year for row in _probe(meeting, reached).collect()]
    found = {}
    unsettled = [year for year in known if year not in changed]
    if unsettled:
        some = meeting.filter(F.col("year").isin(unsettled))
        found = {row.year: row for row in _meeting(some, reached).collect()}
        if any(row.copies > 1 for row in found.values()):
            raise _not_unique()
    changed += [year for year, row in found.items() if row.changed]
    grown = [year for year, row in found.items() if row.absent and not row.changed]

    work = table.copy()
    if new:
        work.replace(incoming.filter(F.col("year").isin(new)), new, unique=True)
    if changed:
        target = table.read(changed)
        _replace_merged(work, target, incoming.filter(F.col("year").isin(changed)), changed)
    # a folder that counts is added to last, when nothing can be refused any more
    if grown:
        fresh = incoming.filter(F.col("year").isin(grown))
        if any(found[year].absent < spans[year].bars for year in grown):
            fresh = keyed.delete_matching(fresh, reached, KEY)
        work.append(fresh, grown)
    table.versions = work.versions
    return total


def _not_unique() -> keyed.DuplicateKeys:
    return keyed.DuplicateKeys(f"batch is not unique on {KEY}")


def _numbered(incoming: DataFrame) -> DataFrame:
    """The bars of a batch, copies of a key numbered, as a join on the key takes them."""
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(KEY[-1]))
    return incoming.select(*KEY, "year", F.struct(*VALUES).alias("__new"), nth.alias("__nth"))


def _stored(reached: DataFrame) -> DataFrame:
    return reached.select(*KEY, F.struct(*VALUES).alias("__stored"))


def _probe(incoming: DataFrame, reached: DataFrame) -> DataFrame:
    """Years in which a stored bar changes, told from some symbols alone.

    One such bar settles its year. A year that does not come out is not settled: it is compared
    whole. A large batch of corrections so spares the comparison before the merge.
    """
    some = F.pmod(F.xxhash64("symbol"), F.lit(PROBE_PART)) == 0
    new = incoming.filter(some).select(*KEY, "year", F.struct(*VALUES).alias("__new"))
    both = new.join(_stored(reached.filter(some)), KEY)
    return both.filter(~F.col("__new").eqNullSafe(F.col("__stored"))).select("year").distinct()


def _meeting(incoming: DataFrame, reached: DataFrame) -> DataFrame:
    """Per year, how many bars of a batch are not stored yet, how many differ, and the most of a key."""
    stored = F.col("__stored").isNotNull()
    return (
        _numbered(incoming)
        .join(_stored(reached), KEY, "left")
        .groupBy("year")
        .agg(
            F.count_if(~stored).alias("absent"),
            F.count_if(stored & ~F.col("__new").eqNullSafe(F.col("__stored"))).alias("changed"),
            F.max("__nth").alias("copies"),
        )
    )


def _replace_merged(table: YearTable, target: DataFrame, incoming: DataFrame, years: list[int]) -> None:
    """Write the years anew, merged: batch bars replace or join the stored ones (``merge_bars``).

    The join's own partitions are the files, so stored bars are shuffled once.
    """
    before = target.count()
    merged = (
        _stored(target)
        .join(_numbered(incoming).drop("year"), KEY, "full_outer")
        .withColumn("__bar", F.coalesce("__new", "__stored"))
        .select(*KEY, "__bar.*", session_year(F.col("date")).alias("year"), "__stored", "__nth")
    )

    def check(seen: dict) -> None:
        if seen["most"] > 1:
            raise _not_unique()
        written = sum(seen[f"y{year}"] for year in years)
        if written != before + seen["added"]:
            raise RuntimeError(f"wrote {written} rows, expected {before + seen['added']}; table unchanged")

    table.replace(
        merged, years, dealt=True, check=check,
        most=F.max("__nth"), added=F.count_if(F.col("__stored").isNull()),
    )
