"""Landed bars -> fact table + touched rollup months, by a file stream."""

from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.plans import rollup as ru
from barwise.session import scratch_path
from barwise.streaming import start_refresh

SF = "/root/testdata/sf0.001"


def test_stream_loads_and_refreshes_idempotently(spark):
    bars = fx.bars_a(spark, SF)
    landing = scratch_path(spark, "landing")
    fact, rollup = scratch_path(spark, "fact"), scratch_path(spark, "bar_1d")
    ckpt = scratch_path(spark, "ckpt")
    early = bars.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    early.write.parquet(landing + "/batch=1")
    q = start_refresh(spark, landing, fact, rollup, "2023-01-01", "2025-01-01", ckpt)
    q.awaitTermination()
    assert spark.read.parquet(fact).count() == early.count()
    # A second landing overlaps the first: the overlap is ignored.
    bars.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) \
        .write.parquet(landing + "/batch=2")
    q = start_refresh(spark, landing, fact, rollup, "2023-01-01", "2025-01-01", ckpt)
    q.awaitTermination()
    stored = spark.read.parquet(fact)
    assert stored.count() == bars.count()
    assert stored.groupBy("ticker_id", "ts").count().where("count > 1").count() == 0
    r = ru.compare(ru.daily_rollup(bars), spark.read.parquet(rollup).select(*ru.DAILY_COLS)).first()
    assert (r.only_left, r.only_right) == (0, 0)
