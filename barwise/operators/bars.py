"""Ticks or bars to OHLCV bars.

Everything is a grouped aggregate with partial (map-side) aggregation:
``min_by`` / ``max_by`` keep one candidate per group and task, so a hot
instrument never gathers its rows in one place before the final merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from barwise.functions.numeric import steady_sum
from barwise.functions.orderkey import Part, order_key

def ohlcv_from_ticks(price: str = "price", size: str = "size",
                     order: Sequence[str | Part] = ("ts",), schema: StructType | None = None) -> list[Column]:
    """Aggregate columns that turn trades into one bar.

    open / close are the prices at the first / last ``order`` key (T8: the
    key must be unique, add tie-breakers); vwap is dollar volume over share
    volume with a zero guard. The dollar volume is a sum of doubles, as
    wide as the prices come, and the same in any order (``steady_sum``).

    With the trades' ``schema``, an order of several columns becomes one
    fixed-width value (``functions.orderkey``), so the bars are a hash
    aggregate; without it the order is a struct and Spark sorts the trades.
    """
    names = [p.column if isinstance(p, Part) else p for p in order]
    key = order_key(schema, order) if schema is not None else F.struct(*names) if len(names) > 1 else F.col(names[0])
    p = F.col(price)
    dollars = steady_sum(p * F.col(size))
    shares = F.sum(F.col(size).cast("bigint"))
    return [
        F.min_by(p, key).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, key).alias("close"),
        shares.alias("volume"),
        F.try_divide(dollars, F.nullif(shares, F.lit(0)).cast("double")).alias("vwap"),
        F.count(F.lit(1)).alias("trade_count"),
    ]


def bar_start(ts: str, width: str) -> Column:
    """Start of the tumbling bucket of ``width`` (e.g. '5 minutes') holding ts."""
    return F.window(F.col(ts), width).start


def bars_from_ticks(ticks: DataFrame, width: str = "5 minutes", key: str = "ticker_id",
                    ts: str = "ts", price: str = "price", size: str = "size",
                    order: Sequence[str | Part] = ("ts",)) -> DataFrame:
    """OHLCV bars of ``width`` per instrument from trades.

    Output schema: ticker_id, ts (bucket start), open, high, low, close,
    volume, vwap, trade_count.
    """
    t = ticks.withColumn("_bucket", bar_start(ts, width))
    aggs = ohlcv_from_ticks(price, size, order, ticks.schema)
    return (t.groupBy(key, "_bucket").agg(*aggs)
            .withColumnRenamed("_bucket", "ts")
            .select(key, "ts", "open", "high", "low", "close", "volume", "vwap", "trade_count"))


def bar_dollars() -> Column:
    """Dollar volume of a bar, volume * vwap, as a double."""
    return F.col("volume") * F.col("vwap")


def ohlcv_from_bars(order: str = "ts") -> list[Column]:
    """Aggregate columns that roll bars into a coarser bar.

    open = open of the first bar, close = close of the last, vwap =
    sum(volume * vwap) / nullif(sum(volume), 0): a bar with a null vwap
    leaves the numerator but keeps its volume in the denominator (T12).
    """
    vol = F.sum("volume")
    return [
        F.min_by("open", F.col(order)).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.col(order)).alias("close"),
        vol.alias("volume"),
        F.try_divide(steady_sum(bar_dollars()),
                     F.nullif(vol, F.lit(0)).cast("double")).alias("vwap"),
        F.sum("trade_count").alias("trade_count"),
    ]
