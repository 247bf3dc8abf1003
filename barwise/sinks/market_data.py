"""The second loader: bars into ``market_data`` keyed by (symbol_id, ts).

Differences from ``layout.load_bars`` follow the reference's second loader:
unknown symbols are added to the symbol table with their symbol as name and
sector 'Unknown' (T22) and known ones get name and sector replaced (upsert,
K8); rows outside the supported range are dropped and counted (P12); a key
already loaded, or seen twice, is ignored (insert-ignore, K7); rows are
sorted by (ts, symbol_id) inside each file (K10); prices are DECIMAL(18,6);
the report counts attempted rows, as the reference does, next to inserted
ones (K9, T23).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barwise.functions.timefn import month_key
from barwise.operators.filters import in_range_cond
from barwise.operators.joins import bounded_broadcast, enrich_symbols
from barwise.operators.refdata import assign_ids
from barwise.session import checkpoint_root, scratch_path
from barwise.sinks.layout import assign_month
from barwise.sinks.merge import first_by_values, upsert
from barwise.sinks.tables import Files, staged

KEYS = ["symbol_id", "ts"]
PRICE, PRICES = "decimal(18,6)", ["open", "high", "low", "close"]


def read_or_none(spark, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None when the path does not exist
    (any other error propagates)."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # noqa: BLE001 - not written yet
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise


def refresh_symbols(bars: DataFrame, meta: DataFrame, symbols_path: str) -> DataFrame:
    """Upsert the batch's symbols into ``symbols(symbol_id, ticker,
    company_name, sector)`` and return the new table (checkpointed, so the
    old files can be replaced). ``bars`` is read once."""
    spark = bars.sparkSession
    checkpoint_root(spark)
    seen = enrich_symbols(bars.select("symbol").distinct().checkpoint(eager=True), meta)
    rows = seen.select(F.col("symbol").alias("ticker"), F.col("name").alias("company_name"),
                       "sector")
    old = read_or_none(spark, symbols_path)
    ids = assign_ids(rows.select("ticker"), old.select("symbol_id", "ticker") if old is not None
                     else None, "symbol_id", ("ticker",))
    fresh = rows.join(ids, "ticker").select("symbol_id", "ticker", "company_name", "sector")
    table = fresh if old is None else upsert(old, fresh, ["ticker"], ["company_name", "sector"])
    table = table.checkpoint(eager=True)
    table.write.mode("overwrite").parquet(symbols_path)
    return table


def load_market_data(bars: DataFrame, meta: DataFrame, path: str, symbols_path: str,
                     start, end) -> dict:
    """Load vendor bars (``read_bars`` schema) into ``path``; returns the
    counters attempted, inserted, out_of_range and symbols.

    ``bars`` may be costly to derive: it is read once, and once more only if
    rows have equal symbol and time. Symbols, counters and the load go
    by a staged table of one row per key, which is removed in the end.
    """
    spark = bars.sparkSession
    staging = scratch_path(spark, "market_batch")
    b = bars.select("symbol", F.col("timestamp").alias("ts"), *[F.col(c).cast(PRICE).alias(c) for c in PRICES],
                    F.col("volume").cast("bigint").alias("volume"))
    batch = first_by_values(b, ["symbol", "ts"], [*PRICES, "volume"], f"{staging}/batch", "rows")
    symbols = refresh_symbols(batch, meta, symbols_path)
    # From the stored table, whose size Spark knows. Rows of a ticker that the metadata repeat load once and count each time.
    ids = bounded_broadcast(spark.read.parquet(symbols_path).groupBy(F.col("ticker").alias("symbol"), "symbol_id")
                            .agg(F.count(F.lit(1)).alias("times")))
    b = batch.join(ids, "symbol").select(*KEYS, *PRICES, "volume", (F.col("rows") * F.col("times")).alias("rows"))
    # Batch-side counters: one aggregate over the batch (small next to the
    # target). Rows ignored as duplicates still count as attempted.
    in_range = in_range_cond("ts", start, end)
    by_month = b.groupBy(F.date_trunc("month", "ts").cast("timestamp_ntz").alias("m")).agg(  # a calendar-bounded list
        *[F.coalesce(F.sum(F.when(c, F.col("rows"))), F.lit(0)).alias(name) for c, name in ((in_range, "attempted"), (~in_range, "out_of_range"))])
    got = by_month.withColumn("month", month_key("m")).collect()
    fresh = assign_month(b.where(in_range).drop("rows"), start, end)
    target = read_or_none(spark, path)
    if target is not None:
        # Only the month partitions the batch writes to.
        parts = [r.month for r in got if r.attempted]
        known = target.where(F.col("month").isin(parts)).select(*KEYS)
        # Staged, so that the range exchange's sampling job does not join once more.
        fresh = staged(fresh.join(known, KEYS, "left_anti"), f"{staging}/fresh")
    # Range-partitioned by month and time, sorted by (ts, symbol_id) as the
    # reference inserts (K10); observed above the range exchange, so its
    # sampling job does not count.
    out = Observation("market_data_out")
    written = (fresh.repartitionByRange("month", "ts", "symbol_id")
               .sortWithinPartitions("month", "ts", "symbol_id")
               .observe(out, F.count(F.lit(1)).alias("inserted")))
    written.write.mode("append").partitionBy("month").parquet(path)
    Files(spark, staging).delete(staging)
    return {"attempted": sum(r.attempted for r in got), "out_of_range": sum(r.out_of_range for r in got),
            "inserted": out.get["inserted"], "symbols": symbols.count()}
