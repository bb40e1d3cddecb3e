"""What a run spends beside its rows: checks, kept results and absent tables."""

from pyspark.sql import functions as F

import data
from closingbell import schemas
from closingbell.session import setting
from closingbell.sources.tables import Store
from plan_text import plan_of


def test_rows_held_for_a_check_are_sized(spark, tmp_path):
    with setting(spark, "spark.sql.shuffle.partitions", 60):
        held = Store(spark, str(tmp_path))._held(spark.range(100).groupBy("id").count())
        try:
            assert held.rdd.getNumPartitions() < 60
        finally:
            held.unpersist()


def test_metrics_see_the_rows_that_are_left_out(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    kept, seen = store.keep(spark.range(10).toDF("n"), "r", "some", only=F.col("n") > 6, n=F.count(F.lit(1)))
    assert seen["n"] == 10 and sorted(r.n for r in kept.collect()) == [7, 8, 9]


def test_an_absent_table_is_empty_to_the_optimiser(spark, tmp_path):
    absent = Store(spark, str(tmp_path)).read("ohlcv_flag")
    assert absent.schema.names == schemas.FLAG.names and "Scan ExistingRDD" not in plan_of(absent)
    assert absent.count() == 0 and data.empty(spark, "ohlcv_flag").union(absent).count() == 0
