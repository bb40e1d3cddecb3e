"""The stored tables of one installation: one fresh folder per version.

A table is never written over the folder it is read from; the caller passes the versions
on, and the folders they no longer name are found by ``operators.maintenance.orphan_files``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from closingbell import schemas
from closingbell.operators import audit
from closingbell.operators import runs as run_log
from closingbell.session import setting
from closingbell.sources.prices import price_table
from closingbell.sources.years import CODEC, YearTable, empty, observed


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Explicit-schema scan; an absent path is an empty table, every other error propagates."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def version_path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/v={version}"


FLAGS = StructType([*schemas.FLAG.fields, StructField("year", IntegerType())])


class IntegrityError(ValueError):
    """Rows about to be stored break a rule of their table."""


class Store:
    """The stored tables of one installation and the version of each that counts.

    A run works on a copy (``begin``) and its versions are taken over when it closes; until then,
    and if it fails, the old ones stay valid. Prices and flags are versioned year by year
    (``prices/2024`` in ``versions``); the run log is appended to and has no version.
    """

    VERSIONED = [name for name in schemas.TABLES if name not in ("ohlcv_flag", "pipeline_run")]

    def __init__(self, spark: SparkSession, root: str, versions: dict[str, int] | None = None):
        self.spark = spark
        self.root = root
        if not versions and self._has_versions():
            raise ValueError(f"{root} holds versioned tables; open it with the versions that count")
        versions = versions or {}
        years = lambda name: {
            int(key.split("/")[1]): v for key, v in versions.items() if key.startswith(f"{name}/")
        }
        self.whole = {name: versions.get(name, 0) for name in self.VERSIONED}
        self.prices = price_table(spark, f"{root}/prices", years("prices"))
        self.flags = YearTable(spark, f"{root}/flags", FLAGS, ["symbol_id", "session_date"], years("flags"))

    def _has_versions(self) -> bool:
        try:
            self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{self.root}/*/v=*")
            return True
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise

    @property
    def versions(self) -> dict[str, int]:
        """What a later session opens the store with."""
        by_year = {
            f"{name}/{year}": version
            for name, table in (("prices", self.prices), ("flags", self.flags))
            for year, version in table.versions.items()
        }
        return self.whole | by_year

    def begin(self) -> Store:
        """A copy for one run; ``take_over`` makes its versions count."""
        work = Store.__new__(Store)
        work.spark, work.root, work.whole = self.spark, self.root, dict(self.whole)
        work.prices, work.flags = self.prices.copy(), self.flags.copy()
        return work

    def take_over(self, work: Store) -> None:
        self.whole = dict(work.whole)
        self.prices, self.flags = work.prices.copy(), work.flags.copy()

    def read(self, table: str) -> DataFrame:
        if table == "ohlcv_flag":
            return self.flags.read().drop("year")
        if table == "pipeline_run":
            return run_log.current(read_or_empty(self.spark, self.log, run_log.ENTRIES))
        path = version_path(self.root, table, self.whole[table])
        return read_or_empty(self.spark, path, schemas.TABLES[table])

    def sql(self, query: str, **args) -> DataFrame:
        """A query over the stored tables by name, its ``:name`` parameters bound."""
        for table in schemas.TABLES:
            self.read(table).createOrReplaceTempView(table)
        self.prices.read().createOrReplaceTempView("prices")
        return self.spark.sql(query, args=args)

    def write(self, table: str, df: DataFrame, now=None, **metrics: Column) -> DataFrame | tuple[DataFrame, dict]:
        """Store the next version of a table; rows that break a rule are never written.

        With ``metrics`` the result is the table and what they came to, collected by the write.
        """
        rows = self._held(schemas.conform(df, table, now))
        try:
            self.check(table, rows)
            version, seen = self.whole[table] + 1, None
            if metrics:
                rows, seen = observed(rows, **metrics)
            # errorifexists would block the retry of a run that died half-way through this write
            rows.write.mode("overwrite").parquet(version_path(self.root, table, version))
        finally:
            rows.unpersist()
        self.whole[table] = version
        return (self.read(table), seen.get) if metrics else self.read(table)

    def replace_flags(self, rows: DataFrame, years: list[int]) -> None:
        """Make ``rows`` all flags of the years; rows that break a rule are never written."""
        rows = self._held(rows.withColumn("year", F.year("session_date")))
        try:
            self.check("ohlcv_flag", rows)
            self.flags.replace(rows, years)
        finally:
            rows.unpersist()

    def _held(self, rows: DataFrame) -> DataFrame:
        """Rows on disk for the check and the write. Adaptive execution sizes their partitions as it
        does in any query: else each of a few rows is a task, with a file for every reducer."""
        with setting(self.spark, "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true"):
            return rows.persist(StorageLevel.DISK_ONLY)

    def check(self, table: str, rows: DataFrame) -> None:
        """Raise where rows about to be stored break a rule that the schemas state."""
        tables = {parent: self.read(parent) for _, parent, _ in schemas.FOREIGN_KEYS.get(table, [])}
        broken = audit.violations(tables | {table: rows}, table).filter("violations > 0").collect()
        if broken:
            raise IntegrityError("; ".join(f"{r.table}: {r.violations} x {r.rule}" for r in broken))

    def log_run(self, entries: DataFrame) -> DataFrame:
        """Append the new state of some runs; returns the log as it is then."""
        self.check("pipeline_run", entries)
        run_log.numbered(entries, read_or_empty(self.spark, self.log, run_log.ENTRIES)).write.mode(
            "append"
        ).parquet(self.log)
        return self.read("pipeline_run")

    def keep(
        self, df: DataFrame, run_id: str, name: str, only: Column | None = None, **metrics: Column
    ) -> DataFrame | tuple[DataFrame, dict]:
        """A run's intermediate result as a table: read several times, computed once.

        With ``metrics`` the result is the table and what they came to, collected by the write;
        they see all rows, also those that ``only`` leaves out of the table.
        """
        path = f"{self.root}/work/{run_id}/{name}"
        seen = None
        if metrics:
            df, seen = observed(df, **metrics)
        if only is not None:
            df = df.filter(only)
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        return (kept, seen.get) if metrics else kept

    @property
    def log(self) -> str:
        return f"{self.root}/pipeline_run"

    def live_paths(self) -> list[str]:
        """Folders that hold current data; everything else under the root is left over."""
        by_version = [version_path(self.root, table, v) for table, v in self.whole.items() if v > 0]
        return [self.log, *by_version, *self.prices.paths(), *self.flags.paths()]
