"""Load landed bars and refresh the touched rollup months, as a stream (K2, K7, M2, M3).

The reference reloads bars and then refreshes its daily rollup (a full
refresh once a day). Here landed bar files drive a Structured Streaming
query over the landing folder; each micro-batch

1. inserts its bars into the month-partitioned fact table, ignoring keys
   already there (insert-ignore: a re-run of the same batch after a lost
   executor or driver restart appends nothing twice), and
2. recomputes the daily rollup for the session months the batch touched,
   from the fact table, and replaces only those month folders.

Bars carry ``ticker_id`` already (see ``sinks.layout.load_bars`` for symbol
resolution). The per-batch month list is collected to the driver; it is
bounded by the calendar (months), not by data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barwise import schema as S
from barwise.functions.timefn import NEW_YORK, local_date, month_key
from barwise.plans.rollup import refresh_daily
from barwise.plans.rollup_state import apply_bars
from barwise.session import checkpoint_root, scratch_path
from barwise.sinks.layout import assign_month, cluster
from barwise.sinks.market_data import read_or_none
from barwise.sinks.merge import first_per_key, new_rows
from barwise.sinks.tables import VersionedTable

KEYS = ["ticker_id", "ts"]


def landed_bars(spark: SparkSession, landing: str, max_files: int | None = None) -> DataFrame:
    """A streaming DataFrame of bar files (schema ``BAR``) under ``landing``."""
    r = spark.readStream.schema(S.BAR)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(landing)


def apply_batch(batch: DataFrame, fact_path: str, rollup_path: str, start: str, end: str,
                tz: str = NEW_YORK) -> list[str]:
    """Insert new bars into the fact table and refresh touched session months.
    Returns the refreshed months."""
    spark = batch.sparkSession
    b = assign_month(first_per_key(batch, KEYS), start, end)
    # Partition months the batch writes to: bounded by the calendar.
    parts = [r.month for r in b.select("month").distinct().collect()]
    fact = read_or_none(spark, fact_path)
    if fact is None:  # first batch: no table yet
        fresh = b
    else:
        fresh = new_rows(fact.where(F.col("month").isin(parts)).select(*KEYS), b, KEYS)
    (cluster(fresh).write.mode("append").partitionBy("month").parquet(fact_path))
    months = [r.m for r in batch.select(month_key(local_date("ts", tz)).alias("m"))
              .distinct().collect()]
    if months:
        bars = spark.read.parquet(fact_path)  # month-partitioned: pruned to the months
        refresh_daily(bars, rollup_path, months, tz=tz)
    return sorted(months)


def apply_batch_states(batch: DataFrame, fact_path: str, state: VersionedTable, start: str, end: str,
                       number: int, tz: str = NEW_YORK, source: str = "") -> bool:
    """Insert new bars into the fact table and merge their states into the rollup
    (``plans.rollup_state``): no stored bar is read but for the keys of the
    batch's months. Returns whether the states changed.

    The states come first, numbered: a batch run again after a failure in
    between finds its number there and only adds its bars.
    """
    spark = batch.sparkSession
    b = assign_month(first_per_key(batch, KEYS), start, end)
    parts = [r.month for r in b.select("month").distinct().collect()]
    fact = read_or_none(spark, fact_path)
    fresh = b if fact is None else new_rows(fact.where(F.col("month").isin(parts)).select(*KEYS), b, KEYS)
    checkpoint_root(spark)
    fresh = fresh.checkpoint(eager=True)  # the new rows must not change once they are in the fact table
    changed = apply_bars(state, fresh, number, source, tz=tz)
    cluster(fresh).write.mode("append").partitionBy("month").parquet(fact_path)
    return changed


def start_refresh(spark: SparkSession, landing: str, fact_path: str, rollup_path: str,
                  start: str, end: str, checkpoint: str | None = None,
                  available_now: bool = True, max_files: int | None = None,
                  incremental: bool = False) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed and stops.

    ``incremental`` keeps the rollup as mergeable states at ``rollup_path``
    instead of recomputing the touched months from their bars.
    """
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        if incremental:
            apply_batch_states(batch, fact_path, VersionedTable(spark, rollup_path), start, end, epoch_id, source=ckpt)
        else:
            apply_batch(batch, fact_path, rollup_path, start, end)

    w = (landed_bars(spark, landing, max_files).writeStream
         .foreachBatch(per_batch).option("checkpointLocation", ckpt))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


__all__ = ["landed_bars", "apply_batch", "apply_batch_states", "start_refresh"]
