"""The engine's input tables, derived from the given tables (all rows of them).

``lineitem`` is read as a tick feed of the suppliers, ``events`` as one of the users;
suppliers and customers give memberships and the ticker snapshot; ``orders`` gives the run
log. Every definition has its SQL twin in ``workload.oracle``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from closingbell import schemas
from closingbell.functions import stable_id
from closingbell.session import configure

NOW = "2002-01-01 06:30:00"
LISTED = "1995-01-02 00:00:00"
AS_OF = "2001-12-31"
RUN_ID = "run-2002-01-01"
RUN_FROM = "2001-06-01"


class Views:
    """Lazily planned views over one scale factor's folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- price feeds ---------------------------------------------------------------

    def ticks(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("key"),
            F.to_date("l_shipdate").alias("date"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_quantity").alias("qty"),
            # order, line, part and price in one number: a bar folds in a hash table, no sort
            _packed((F.col("l_orderkey"), 12), (F.col("l_linenumber"), 2), (F.col("l_partkey"), 10),
                    (F.round(F.col("l_extendedprice") * 100), 12)).alias("ord"),
            "l_returnflag",
        )

    def bars(self, ticks: DataFrame | None = None) -> DataFrame:
        ticks = self.ticks() if ticks is None else ticks
        return _to_bars(ticks, F.sum("qty").cast("bigint"))

    def event_bars(self) -> DataFrame:
        ticks = self.table("events").select(
            F.col("user_id").alias("key"),
            F.to_date("ts").alias("date"),
            F.col("value").alias("price"),
            _packed((F.unix_micros(F.col("ts").cast("timestamp")), 18), (F.col("event_id"), 18)).alias("ord"),
        )
        return _to_bars(ticks, F.round(F.sum("price") * 100).cast("bigint"))

    def corrections(self) -> DataFrame:
        """A batch that meets stored bars (returned lines) and brings new ones (events)."""
        returned = self.bars(self.ticks().filter("l_returnflag = 'R'"))
        return returned.unionByName(self.event_bars())

    def history(self) -> DataFrame:
        """Bars stored before the sessions that a run is given, in the vendor's cents."""
        cents = [F.round(F.col(c) * 100).alias(c) for c in ("open", "high", "low", "close")]
        early = self.bars().filter(F.col("date") < F.lit(RUN_FROM).cast("date"))
        return early.select("symbol", "date", *cents, "volume")

    def late_landing(self) -> DataFrame:
        """Payloads of the sessions from ``RUN_FROM`` on."""
        first = F.datediff(F.lit(RUN_FROM).cast("date"), F.lit("1970-01-01").cast("date"))
        return self.landing().filter(F.col("seq") >= first)

    def prices(self) -> DataFrame:
        return self.bars().withColumn("year", F.year("date"))

    def calendar(self) -> DataFrame:
        """Weekdays on which anything traded."""
        return (
            self.table("lineitem")
            .select(F.to_date("l_shipdate").alias("session_date"))
            .distinct()
            .filter(~F.dayofweek("session_date").isin(1, 7))
        )

    # -- vendor payloads -----------------------------------------------------------

    def landing(self) -> DataFrame:
        """Each bar as a payload of two candles; its volume decides which damage it has."""
        cents = {name: F.round(F.col(name) * 100).cast("bigint") for name in
                 ("open", "high", "low", "close")}
        day = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("bigint")
        ms = day * 86400000 + 18000000
        volume = F.col("volume")
        late = F.when(volume == 4, ms - 5 * 86400000).otherwise(ms)
        fields = {
            "datetime": F.when(volume == 11, F.lit("null")).otherwise(late.cast("string")),
            "open": F.when(volume == 5, F.lit("null"))
            .when(volume == 9, (cents["low"] - 1).cast("string"))
            .otherwise(cents["open"].cast("string")),
            "high": F.when(volume == 6, F.lit("0"))
            .when(volume == 8, (cents["close"] - 1).cast("string"))
            .otherwise(cents["high"].cast("string")),
            "low": cents["low"].cast("string"),
            "close": F.when(volume == 13, F.lit("-7")).otherwise(cents["close"].cast("string")),
            "volume": F.when(volume == 7, F.lit("-3"))
            .when(volume == 12, F.lit("0.5"))
            .otherwise(volume.cast("string")),
        }
        last = _json(fields)
        stale = _json({**{k: F.lit("1") for k in fields}, "datetime": F.lit("86400000")})
        body = (
            F.when(volume == 1, F.repeat(F.lit("server error "), 20))
            .when(volume == 2, F.lit('{"empty":true,"candles":[]}'))
            .when(volume == 3, F.lit('{"empty":false}'))
            .when(volume == 10, F.lit("<html>"))
            .otherwise(F.concat(F.lit('{"empty":false,"candles":['), stale, F.lit(","), last,
                                F.lit("]}")))
        )
        return self.bars().select(
            "symbol",
            F.when(volume == 1, 503).otherwise(200).cast("int").alias("status_code"),
            body.alias("body"),
            day.alias("seq"),
            (F.date_add("date", 1).cast("timestamp_ntz") + F.expr("INTERVAL '6:30' HOUR TO MINUTE"))
            .alias("fetched_at"),
        )

    # -- universes -----------------------------------------------------------------

    def _places(self) -> DataFrame:
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select("n_nationkey", "n_name", "r_name")

    def _suppliers(self) -> DataFrame:
        return self.table("supplier").join(
            self._places(), F.col("s_nationkey") == F.col("n_nationkey")
        )

    def _customers(self) -> DataFrame:
        return self.table("customer").join(
            self._places(), F.col("c_nationkey") == F.col("n_nationkey")
        )

    def tickers(self) -> DataFrame:
        """The snapshot: every customer, those in debt a second time in another spelling."""
        key = F.col("c_custkey").cast("string")
        customers = self._customers()
        return customers.select(
            F.concat(F.lit("T."), key).alias("ticker"), F.col("r_name").alias("universe")
        ).unionByName(
            customers.filter("c_acctbal < 0").select(
                F.concat(F.lit("T-"), key).alias("ticker"), F.col("r_name").alias("universe")
            )
        )

    def universe(self) -> DataFrame:
        names = self.table("region").select(F.col("r_name").alias("name")).unionByName(
            self.table("nation").select(F.col("n_name").alias("name"))
        )
        rows = names.select(F.col("name").alias("id"), "name")
        return schemas.conform(rows, "universe", LISTED)

    def membership(self) -> DataFrame:
        """Suppliers and customers in debt have been listed before."""
        symbols = self.table("supplier").select(_symbol("s_suppkey")).unionByName(
            self.table("customer").filter("c_acctbal < 0").select(_symbol("c_custkey"))
        ).distinct()
        rows = symbols.select(stable_id("membership", F.col("symbol")).alias("id"), "symbol")
        return schemas.conform(rows, "membership", LISTED)

    def universe_membership(self) -> DataFrame:
        """Suppliers are open in their region and nation; customers in debt have left."""
        suppliers = self._suppliers()
        listed = [
            suppliers.select(
                _symbol("s_suppkey"), F.col(place).alias("universe_id"),
                F.lit("1998-01-01").alias("enter_date"), F.lit(None).alias("exit_date"),
            )
            for place in ("r_name", "n_name")
        ]
        left = self._customers().filter("c_acctbal < 0").select(
            _symbol("c_custkey"), F.col("r_name").alias("universe_id"),
            F.lit("1995-01-02").alias("enter_date"), F.lit("1997-06-30").alias("exit_date"),
        )
        rows = reduce(lambda a, b: a.unionByName(b), [*listed, left])
        member = stable_id("membership", F.col("symbol"))
        rows = rows.select(
            stable_id("universe_membership", member, F.col("universe_id"), F.col("enter_date"))
            .alias("id"),
            member.alias("membership_id"), "universe_id", "enter_date", "exit_date",
        )
        return schemas.conform(rows, "universe_membership", LISTED)

    # -- stored state --------------------------------------------------------------

    def dlq(self) -> DataFrame:
        symbol = F.concat(F.lit("T/"), F.col("c_custkey").cast("string"))
        member = stable_id("membership", symbol)
        attempts = F.col("c_nationkey")
        created = F.lit(LISTED).cast("timestamp_ntz") + F.make_dt_interval(F.col("c_nationkey"))
        return schemas.conform(
            self.table("customer").filter("c_acctbal < 0").select(
                stable_id("failed_ingestion", member).alias("id"),
                member.alias("symbol_id"),
                symbol.alias("raw_symbol"),
                created.alias("created_at"),
                F.lit("HTTP_ERROR").alias("failure"),
                F.lit("earlier").alias("failure_error"),
                (created + F.expr("INTERVAL 1 HOUR")).alias("retry_after"),
                attempts.alias("attempts"),
                (attempts >= 3).alias("review_required"),
            ),
            "failed_ingestion",
        )

    def volatility(self) -> DataFrame:
        """Baselines of every listed symbol, stored before the current run."""
        members = self.membership()
        return schemas.conform(
            members.select(
                stable_id("volatility_rolling", F.col("id")).alias("id"),
                F.col("id").alias("symbol_id"),
                F.lit(0.5).alias("rolling_sd"),
                F.length("symbol").cast("double").alias("rolling_avg_volume"),
            ),
            "volatility_rolling",
            LISTED,
        )

    def runs(self) -> DataFrame:
        """One started run per order; urgent ones are price runs."""
        return schemas.conform(
            self.table("orders").select(
                F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("id"),
                F.when(F.col("o_orderpriority") == "1-URGENT", "prices").otherwise("universes")
                .alias("dag_id"),
                F.to_date("o_orderdate").alias("run_date"),
                F.lit("RUNNING").alias("status"),
                (F.to_date("o_orderdate").cast("timestamp_ntz")
                 + F.make_dt_interval(F.lit(0), F.lit(6), F.col("o_custkey").cast("int")))
                .alias("started_at"),
            ),
            "pipeline_run",
        )

    def outcomes(self) -> DataFrame:
        """Symbols attempted and written per run, from the order's lines; a run without
        lines wrote nothing and knows no attempts."""
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.count("*").alias("attempted"),
            F.count_if(F.col("l_returnflag") != "R").alias("written"),
            F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
            .alias("dlq_failures"),
        )
        return self.table("orders").join(
            lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"
        ).select(
            F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("id"),
            F.coalesce("written", F.lit(0)).alias("written"),
            # partly filled orders lost the list of what they attempted
            F.when(F.col("o_orderstatus") != "P", F.col("attempted")).alias("attempted"),
            F.coalesce("dlq_failures", F.lit(0)).alias("dlq_failures"),
        )

    def run_failures(self) -> DataFrame:
        """Failed orders; the not urgent ones do not know their run id."""
        urgent = F.col("o_orderpriority") == "1-URGENT"
        return self.table("orders").filter("o_orderstatus = 'F'").select(
            F.when(urgent, F.concat(F.lit("run-"), F.col("o_orderkey").cast("string"))).alias("id"),
            F.when(urgent, "prices").otherwise("universes").alias("dag_id"),
            F.to_date("o_orderdate").alias("run_date"),
            F.concat(F.lit("failed at "), F.col("o_orderkey").cast("string")).alias("error"),
        )


def _packed(*parts: tuple[Column, int]) -> Column:
    """Whole numbers of at most so many digits as one decimal that sorts as they do in turn."""
    number = F.lit(0).cast("decimal(1,0)")
    for value, digits in parts:
        shift = F.lit("1" + "0" * digits).cast(f"decimal({digits + 1},0)")
        number = (number * shift + value.cast(f"decimal({digits},0)")).cast("decimal(38,0)")
    return number


def _symbol(key: str) -> Column:
    return F.concat(F.lit("T/"), F.col(key).cast("string")).alias("symbol")


def _json(fields: dict[str, Column]) -> Column:
    parts = [
        F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()
    ]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _to_bars(ticks: DataFrame, volume: Column) -> DataFrame:
    """One bar per (symbol, date); ticks of a bar are folded before the shuffle."""
    # by the symbol itself: bars then are dealt by their key, which merges and stores need
    bars = ticks.groupBy(_symbol("key"), "date").agg(
        F.min_by("price", "ord").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "ord").alias("close"),
        volume.alias("volume"),
    )
    return bars.select("symbol", "date", "open", "high", "low", "close", "volume")
