"""Universe snapshots against dated membership history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from closingbell import schemas
from closingbell.functions import normalise_symbol, stable_id
from closingbell.functions.dates import as_date
from closingbell.operators import keyed
from closingbell.operators.positions import DIGITS, number_rows, paged_lists

# Fixed value: symbols per fetch batch.
BATCH_SIZE = 100
# Fixed value: buckets of a universe that are compared by digest.
DIFF_BUCKETS = 4096


def imported_symbols(tickers: DataFrame) -> DataFrame:
    """``(universe, symbol)`` of a snapshot, tickers normalised.

    Two spellings of a ticker become one symbol; the diff folds the copies in its own
    grouping, so they cost no shuffle here.
    """
    return tickers.select("universe", normalise_symbol(F.col("ticker")).alias("symbol"))


def active_memberships(universe_membership: DataFrame) -> DataFrame:
    return universe_membership.filter(F.col("exit_date").isNull())


def active_symbols(universe_membership: DataFrame, membership: DataFrame) -> DataFrame:
    """Distinct symbols with an open membership in any universe: the daily fetch list."""
    listed = active_memberships(universe_membership).select(
        F.col("membership_id").alias("id")
    )
    # ids are made distinct first, so an id listed in very many universes stays one row
    return membership.join(listed.distinct(), "id", "left_semi").select("symbol").distinct()


def active_by_universe(
    universe_membership: DataFrame, membership: DataFrame, imported: DataFrame
) -> DataFrame:
    """Active ``(universe, symbol)`` of the imported universes, in one join for all."""
    universes = imported.select(F.col("universe").alias("universe_id"))
    return (
        keyed.keep_listed(
            active_memberships(universe_membership), universes, ["universe_id"], ["membership_id"]
        )
        .join(membership.select(F.col("id").alias("membership_id"), "symbol"), "membership_id")
        .select(F.col("universe_id").alias("universe"), "symbol")
    )


def universe_diff(imported: DataFrame, active: DataFrame) -> DataFrame:
    """``(universe, symbol, change)`` with change ``new`` or ``delisted``.

    ``active`` covers imported universes only, so a universe missing from the snapshot is
    left alone. One grouping answers both directions: a pair seen on one side only is a
    change, and copies of a pair are folded before the shuffle.
    """
    sides = imported.select("universe", "symbol", F.lit(True).alias("__listed")).unionByName(
        active.select("universe", "symbol", F.lit(False).alias("__listed"))
    )
    return (
        sides.groupBy("universe", "symbol")
        .agg(F.min("__listed").alias("__all"), F.max("__listed").alias("__any"))
        .filter(F.col("__all") == F.col("__any"))
        .select(
            "universe",
            "symbol",
            F.when(F.col("__all"), F.lit("new")).otherwise(F.lit("delisted")).alias("change"),
        )
    )


def diff_by_digest(
    imported: DataFrame, universe_membership: DataFrame, membership: DataFrame, buckets: int = DIFF_BUCKETS
) -> DataFrame:
    """``universe_diff`` of a snapshot and the stored history, joining only what differs.

    Both sides are summed up by universe and bucket, order-free, from the membership ids alone (an
    id follows from its symbol). Buckets with equal sums are left out; for the others the stored
    symbols are looked up and compared. An unchanged snapshot looks up none. Ids made in another way
    make every bucket differ, which costs the whole comparison and changes nothing else.
    """
    bucket = F.pmod(F.xxhash64("membership_id"), F.lit(buckets)).alias("bucket")
    listed = imported.select("universe", "symbol").distinct()
    listed = listed.select(
        "universe", "symbol", stable_id("membership", F.col("symbol")).alias("membership_id")
    ).select("*", bucket)
    universes = imported.select(F.col("universe").alias("universe_id"))
    stored = keyed.keep_listed(
        active_memberships(universe_membership), universes, ["universe_id"], ["membership_id"]
    ).select(F.col("universe_id").alias("universe"), "membership_id", bucket)

    def sums(rows: DataFrame) -> DataFrame:
        hashes = (F.bit_xor(F.xxhash64(F.lit(seed), "membership_id")) for seed in (1, 2))
        return rows.groupBy("universe", "bucket").agg(F.struct(F.count("*"), *hashes).alias("sums"))

    both = sums(listed).join(
        sums(stored).withColumnRenamed("sums", "stored_sums"), ["universe", "bucket"], "full"
    )
    differing = both.filter(~F.col("sums").eqNullSafe(F.col("stored_sums"))).select("universe", "bucket")
    left = stored.join(differing, ["universe", "bucket"], "left_semi")
    active = left.join(membership.select(F.col("id").alias("membership_id"), "symbol"), "membership_id")
    return universe_diff(listed.join(differing, ["universe", "bucket"], "left_semi"), active)


def added(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change") == "new").select("universe", "symbol")


def dropped(diff: DataFrame) -> DataFrame:
    return diff.filter(F.col("change") == "delisted").select("universe", "symbol")


def insert_memberships(membership: DataFrame, diff: DataFrame, now) -> DataFrame:
    """Membership with a row for every newly listed symbol; known symbols are untouched."""
    fresh = added(diff).select(stable_id("membership", F.col("symbol")).alias("id"), "symbol")
    return keyed.insert_absent(
        membership, schemas.conform(fresh, "membership", now), ["symbol"]
    )


def relist(
    universe_membership: DataFrame, membership: DataFrame, diff: DataFrame, as_of, now
) -> DataFrame:
    """New open rows. Only open rows block an insert, so a symbol that left and came back
    gets a second row and keeps its closed one."""
    entered = as_date(as_of)
    fresh = added(diff).join(membership.select(F.col("id").alias("membership_id"), "symbol"), "symbol")
    rows = fresh.select(
        stable_id(
            "universe_membership", F.col("membership_id"), F.col("universe"), entered
        ).alias("id"),
        "membership_id",
        F.col("universe").alias("universe_id"),
        entered.alias("enter_date"),
    )
    return keyed.insert_absent(
        universe_membership,
        schemas.conform(rows, "universe_membership", now),
        ["membership_id", "universe_id"],
        among="exit_date IS NULL",
    )


def close_memberships(
    universe_membership: DataFrame, membership: DataFrame, diff: DataFrame, as_of, now
) -> DataFrame:
    """The membership history with the delisted pairs' open rows closed."""
    leaving = (
        dropped(diff)
        .join(membership.select(F.col("id").alias("membership_id"), "symbol"), "symbol")
        .select("membership_id", F.col("universe").alias("universe_id"))
    )
    return keyed.update_matching(
        universe_membership,
        leaving,
        ["membership_id", "universe_id"],
        {"exit_date": as_date(as_of), "updated_at": schemas.clock(now)},
        where=F.col("exit_date").isNull(),
    )


def tickers_by_universe(tickers: DataFrame, page_size: int = 1000) -> DataFrame:
    """Universe -> tickers, as bounded pages of the distinct tickers."""
    return paged_lists(
        tickers.select("universe", "ticker").distinct(), ["universe"], "ticker", page_size
    )


def delisting_report(imported: DataFrame, diff: DataFrame, page_size: int = 1000) -> DataFrame:
    """Per imported universe: how many symbols left, and which, page by page.

    A universe without delistings has one row with a zero and an empty list.
    """
    gone = dropped(diff)
    pages = paged_lists(gone, ["universe"], "symbol", page_size).select(
        "universe", F.col("group_size").alias("delisted"), "page", "members"
    )
    # the totals ride on the pages: a join on the universe would crowd a large one's pages
    quiet = imported.select("universe").distinct().join(
        gone.select("universe").distinct(), "universe", "left_anti"
    )
    return pages.unionByName(
        quiet.select(
            "universe",
            F.lit(0).cast("bigint").alias("delisted"),
            F.lit(0).cast("bigint").alias("page"),
            F.array().cast("array<string>").alias("members"),
        )
    )


def symbol_batches(
    symbols: DataFrame, batch_size: int = BATCH_SIZE, digits: int = DIGITS
) -> DataFrame:
    """Fetch batches of a fixed size over distinct symbols, numbered without a global sort."""
    return number_rows(symbols.select("symbol"), [], "symbol", digits).select(
        "symbol", F.floor(F.col("position") / batch_size).cast("bigint").alias("batch_id")
    )


def symbol_lookup(rows: DataFrame, membership: DataFrame) -> DataFrame:
    """Rows with their ``symbol_id``; a symbol without a membership has none and drops out."""
    return rows.join(membership.select(F.col("id").alias("symbol_id"), "symbol"), "symbol")


def unknown_symbols(rows: DataFrame, membership: DataFrame) -> DataFrame:
    """What ``symbol_lookup`` dropped, per symbol with the number of rows."""
    return (
        rows.groupBy("symbol")
        .agg(F.count("*").alias("rows"))
        .join(membership.select("symbol"), "symbol", "left_anti")
    )
