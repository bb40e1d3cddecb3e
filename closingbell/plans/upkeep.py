"""Store upkeep: compaction first, then the files nothing refers to any more."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from closingbell.operators import maintenance
from closingbell.sources.tables import Store


def run_upkeep(
    store: Store,
    run_id: str,
    as_of: dt.datetime,
    retention_hours: int = maintenance.RETENTION_HOURS,
    dry_run: bool = True,
    allow_short: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Compaction figures per year, and the left-over files past the retention.

    Files are deleted only with ``dry_run=False``. What compaction itself leaves behind is
    younger than the retention and goes in a later run.
    """
    packed = maintenance.compact_prices(store.prices)
    found = store.keep(
        maintenance.orphan_files(
            store.spark, store.root, store.live_paths(), as_of, retention_hours, allow_short
        ),
        run_id,
        "orphans",
    )
    if not dry_run:
        maintenance.remove_files(store.spark, found)
    return packed, found
