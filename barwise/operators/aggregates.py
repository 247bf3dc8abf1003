"""Summary aggregates over bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.operators.joins import with_symbol


def load_summary(bars: DataFrame, key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """Rows, distinct instruments, first and last bar time in one row (A1)."""
    return bars.agg(F.count(F.lit(1)).alias("total_bars"),
                    F.countDistinct(key).alias("distinct_tickers"),
                    F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def date_bounds(bars: DataFrame, ts: str = "ts") -> DataFrame:
    """Earliest and latest bar time (A2)."""
    return bars.agg(F.min(ts).alias("mn"), F.max(ts).alias("mx"))


def most_active(bars: DataFrame, dims: DataFrame, n: int = 5) -> DataFrame:
    """Instruments with the most bars; symbol breaks ties.

    Counting happens before the join, so only one row per instrument
    meets the dimension, and the top N is a TakeOrderedAndProject.
    """
    counts = bars.groupBy("ticker_id").agg(F.count(F.lit(1)).alias("bars"))
    return (with_symbol(counts, dims).select("symbol", "bars")
            .orderBy(F.col("bars").desc(), F.col("symbol").asc()).limit(n))


def partition_stats(bars: DataFrame, part_col: str = "month", key: str = "ticker_id",
                    ts: str = "ts") -> DataFrame:
    """Exact rows, time span and instruments per partition (A4)."""
    return bars.groupBy(part_col).agg(
        F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"), F.countDistinct(key).alias("tickers"))


def files_per_partition(bars: DataFrame, part_col: str = "month") -> DataFrame:
    """Data files and their bytes behind each partition of a stored table
    (A4's size). Distinct (file, size) pairs first, so each file counts once."""
    files = bars.select(part_col, F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_size").alias("bytes")).distinct()
    return files.groupBy(part_col).agg(F.count(F.lit(1)).alias("files"),
                                       F.sum("bytes").alias("bytes"))


def market_volume(bars: DataFrame, ts: str = "ts") -> DataFrame:
    """Dollar volume, share volume and bar count per bar time across all
    instruments (A10, F12). Dollars are a sum of doubles."""
    return bars.groupBy(ts).agg(F.sum(F.col("volume") * F.col("vwap")).alias("dollar_volume"),
                                F.sum("volume").alias("share_volume"),
                                F.count(F.lit(1)).alias("bars"))


def distinct_sorted(df: DataFrame, *cols: str) -> DataFrame:
    """SELECT DISTINCT cols ORDER BY cols."""
    return df.select(*cols).distinct().orderBy(*cols)
