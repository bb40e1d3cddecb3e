"""Session calendar lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed value: how far back the last session is searched for.
SEARCH_DAYS = 10


def previous_sessions(calendar: DataFrame, search_days: int = SEARCH_DAYS) -> DataFrame:
    """``(as_of, prev_session)``: the last session strictly before each date.

    A session serves the dates after it up to the search window, so the as-of lookup is a
    plain equi-join on a table with one row per date. Dates bound its size (at most
    3.7 million rows, whatever the data volume); a date with no session in reach is absent.
    """
    return (
        calendar.select(
            F.col("session_date"),
            F.explode(
                F.sequence(
                    F.date_add("session_date", 1), F.date_add("session_date", search_days)
                )
            ).alias("as_of"),
        )
        .groupBy("as_of")
        .agg(F.max("session_date").alias("prev_session"))
    )


def with_previous_session(df: DataFrame, as_of: str, calendar: DataFrame) -> DataFrame:
    """Adds ``prev_session`` for the date column ``as_of``; null where none is in reach.

    The lookup table is bounded by the number of calendar dates, so broadcasting it is
    safe at any scale, and rows crowded on one date need no shuffle.
    """
    sessions = previous_sessions(calendar).withColumnRenamed("as_of", as_of)
    return df.join(F.broadcast(sessions), as_of, "left")
