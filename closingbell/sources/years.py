"""Tables stored by year: one folder for each year and version of it.

A year that changes is written whole into the folder of its next version by one plain job, which counts
its rows while it writes them; what readers see is decided by ``versions`` alone. New rows of a
year are appended to the folder that counts. Left-over folders are listed by
``operators.maintenance.orphan_files``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from closingbell.operators.keyed import DuplicateKeys
from closingbell.session import setting


# Fixed value: bars take about a quarter less room than with Spark's own choice.
CODEC = "zstd"
# Fixed value: years a write task holds open; it sorts what is left by year when it meets more.
OPEN_YEARS = 16


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, and the optimiser knows it: joins and unions with them fall away."""
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields]
    return spark.range(0).filter(F.lit(False)).select(*nulls)


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The rows, and metrics that are collected by the next job that runs over them."""
    seen = Observation()
    return df.observe(seen, *(value.alias(name) for name, value in metrics.items())), seen


class YearTable:
    """A table with a ``year`` column; ``versions`` names the version of each year that counts."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType,
        order: list[str],
        versions: dict[int, int] | None = None,
    ):
        self.spark, self.root, self.schema, self.order = spark, root, schema, order
        self.versions = dict(versions or {})

    def copy(self) -> YearTable:
        return YearTable(self.spark, self.root, self.schema, self.order, self.versions)

    def paths(self, years: list[int] | None = None) -> list[str]:
        return [
            f"{self.root}/year={year}/v={version}"
            for year, version in sorted(self.versions.items())
            if years is None or year in years
        ]

    def read(self, years: list[int] | None = None) -> DataFrame:
        """The rows; ``years`` prunes folders, and so does a filter on ``year``."""
        found = self.paths(years)
        if not found:
            return empty(self.spark, self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*found)
        return rows.select(*self.schema.names)

    def fill(self, rows: DataFrame) -> int:
        """Make ``rows`` the first content of an empty table in one pass, whichever years they lie in;
        returns their number. They must be unique on ``order``; those without a year are not stored."""
        # not a plain constant: the optimiser would drop it from the window's sort, and sort again
        rows, copied = self._clustered(rows.withColumn("v", F.when(F.col("year").isNotNull(), 1)))
        rows, seen = observed(
            rows,
            rows=F.count(F.lit(1)),
            copies=F.count_if(copied),
            years=F.collect_set("year"),  # bounded by the calendar
        )
        self._write(rows.filter(F.col("year").isNotNull()), "overwrite")
        self._refuse(seen.get["copies"])
        self.versions = {year: 1 for year in seen.get["years"]}
        return seen.get["rows"]

    def replace(
        self,
        rows: DataFrame,
        years: list[int],
        expected: int | None = None,
        dealt: bool = False,
        unique: bool = False,
        check: Callable[[dict], None] | None = None,
        **metrics: Column,
    ) -> dict[int, int]:
        """Make ``rows`` the whole content of ``years``; returns the rows of each. ``dealt``: every
        partition of the rows is a file already. ``unique``: refuse rows that repeat ``order``. ``check``
        sees what ``metrics`` came to (and ``y2024`` and so on, the rows of a year) and may raise.

        The rows may be derived from the table: the folders they are read from stay. A year that is
        left without rows is no longer in the table.
        """
        following = {year: self.versions.get(year, 0) + 1 for year in years}
        seen = self._save(rows, following, "overwrite", dealt, unique, **metrics)
        if unique:
            self._refuse(seen["copies"])
        if check is not None:
            check(seen)
        found = {year: seen[f"y{year}"] for year in years}
        total = sum(found.values())
        if expected is not None and total != expected:
            raise RuntimeError(f"wrote {total} rows, expected {expected}; table unchanged")
        for year in years:
            if found[year]:
                self.versions[year] = following[year]
            else:
                self.versions.pop(year, None)
        return found

    def append(self, rows: DataFrame, years: list[int]) -> None:
        """Add rows of years that the table has."""
        self._save(rows, {year: self.versions[year] for year in years}, "append")

    def _refuse(self, copies: int) -> None:
        if copies:
            raise DuplicateKeys(f"batch is not unique on {self.order}")

    def _clustered(self, rows: DataFrame) -> tuple[DataFrame, Column]:
        """Rows as the files hold them, and whether a row repeats an earlier one: the sort of the write
        tells, and rows that are dealt by ``order`` already are not shuffled for it."""
        own = Window.partitionBy(*self.order, "year", "v").orderBy(self.order[-1])
        return rows.withColumn("__copied", F.row_number().over(own) > 1), F.col("__copied")

    def _save(
        self,
        rows: DataFrame,
        versions: dict[int, int],
        mode: str,
        dealt: bool = False,
        unique: bool = False,
        **metrics: Column,
    ) -> dict:
        version = F.lit(None).cast("int")
        for year, number in versions.items():  # bounded by the calendar
            version = F.when(F.col("year") == year, number).otherwise(version)
        rows = rows.withColumn("v", version)
        if unique:
            rows, copied = self._clustered(rows)
            metrics["copies"] = F.count_if(copied)
        elif not dealt:  # adaptive execution sizes the tasks: a year of any size is split, small ones share
            rows = rows.hint("rebalance", "year")
        counts = {f"y{year}": F.count_if(F.col("year") == year) for year in versions}
        rows, seen = observed(rows, **counts, **metrics)
        self._write(rows, mode)
        return seen.get

    def _write(self, rows: DataFrame, mode: str) -> None:
        # sorted files give a filter on the leading column row groups to skip. A task keeps the files of its
        # years open beside each other, so its rows need no order by year: the leading column alone, whose
        # first bytes a sort compares in place, settles most comparisons
        with setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_YEARS):
            rows.select(*self.schema.names, "v").sortWithinPartitions(*self.order).write.mode(mode).option(
                "partitionOverwriteMode", "dynamic"
            ).option("compression", CODEC).partitionBy("year", "v").parquet(self.root)
