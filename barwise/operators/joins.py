"""Fact-to-dimension joins.

Dimensions (instruments, industries, sectors) are small, but "small" is
checked, not assumed: ``bounded_broadcast`` hints a broadcast only when the
plan's own size statistic (file sizes for tables) is below a bound. Above it
the join stays a shuffle join that AQE may still turn into a broadcast from
runtime sizes, and whose skewed partitions AQE splits. No job runs to decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes (plan statistic) a side may have and still be broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def plan_bytes(df: DataFrame) -> int:
    """Spark's size statistic of the optimised plan; very large when unknown."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when the plan's size statistic is within ``max_bytes``, else ``df``."""
    return F.broadcast(df) if plan_bytes(df) <= max_bytes else df


def with_symbol(bars: DataFrame, dims: DataFrame, cols=("symbol",)) -> DataFrame:
    """Inner join of facts to the instrument list on ticker_id."""
    d = dims.select("ticker_id", *cols)
    return bars.join(bounded_broadcast(d), "ticker_id")


def instruments(ticker: DataFrame, industry: DataFrame, sector: DataFrame) -> DataFrame:
    """ticker -> industry -> sector chain (J2). Instruments without an
    industry drop out, as with the reference's inner joins."""
    ind = industry.select("industry_id", "sector_id", F.col("name").alias("industry"))
    sec = sector.select("sector_id", F.col("name").alias("sector"))
    # One size check on the (industry, sector) chain; the inner join of two
    # dimensions is left to the planner's own size-based choice.
    chain = ind.join(sec, "sector_id")
    return ticker.join(bounded_broadcast(chain), "industry_id")


def symbols_without_bars(dims: DataFrame, bars: DataFrame, key: str = "ticker_id") -> DataFrame:
    """Instruments with no fact rows (J6): a left anti join.

    The fact side is reduced to its distinct keys first (partial aggregate
    on the map side), so only one row per key and task is shuffled.
    """
    keys = bars.select(key).distinct()
    return dims.join(keys, key, "left_anti")


def resolve_ids(bars: DataFrame, dims: DataFrame, on_unknown: str = "drop",
                symbol_col: str = "symbol") -> tuple[DataFrame, DataFrame]:
    """Symbol -> ticker_id lookup.

    Returns (resolved, unknown). ``on_unknown="drop"`` is the first loader's
    rule (unknown symbols are skipped and counted); ``"add"`` keeps them with
    a null ticker_id so the caller can add them to the instrument list, like
    the second loader does.
    """
    if on_unknown not in ("drop", "add"):
        raise ValueError("on_unknown must be 'drop' or 'add'")
    d = bounded_broadcast(dims.select(F.col("symbol").alias(symbol_col), "ticker_id"))
    joined = bars.join(d, symbol_col, "left")
    unknown = joined.where(F.col("ticker_id").isNull())
    resolved = joined if on_unknown == "add" else joined.where(F.col("ticker_id").isNotNull())
    return resolved, unknown


def enrich_symbols(symbols: DataFrame, meta: DataFrame, symbol_col: str = "symbol",
                   default_sector: str = "Unknown") -> DataFrame:
    """Lookup with defaults (J10): name falls back to the symbol, sector to
    'Unknown'. ``meta`` has (symbol, name, sector)."""
    m = bounded_broadcast(meta.select(F.col("symbol").alias(symbol_col), "name", "sector"))
    j = symbols.join(m, symbol_col, "left")
    return j.select(
        symbol_col,
        F.coalesce(F.col("name"), F.col(symbol_col)).alias("name"),
        F.coalesce(F.col("sector"), F.lit(default_sector)).alias("sector"))
