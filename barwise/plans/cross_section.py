"""Cross-section snapshot.

One scan reads the bars at t and at t - 1 day (both pushed to Parquet as an
IN filter); a grouped aggregate per instrument pivots them into close and
prior close. That replaces the reference's self join and left join with a
single shuffle of at most two rows per instrument.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions.numeric import round_dec, simple_return
from barwise.functions.timefn import prior_day, ts_lit
from barwise.operators.filters import at_times, by_sector
from barwise.operators.joins import bounded_broadcast, with_symbol


def snapshot(bars: DataFrame, t) -> DataFrame:
    """(ticker_id, close, prev_close) for instruments with a bar at t."""
    now = ts_lit(t) if not hasattr(t, "alias") else t
    before = prior_day(now)
    two = at_times(bars, [now, before]).select("ticker_id", "ts", "close")
    per = two.groupBy("ticker_id").agg(
        F.max(F.when(F.col("ts") == now, F.col("close"))).alias("close"),
        F.max(F.when(F.col("ts") == before, F.col("close"))).alias("prev_close"),
        F.count_if(F.col("ts") == now).alias("_now"))
    return per.where("_now > 0").drop("_now")


def cross_section(bars: DataFrame, dims: DataFrame, t) -> DataFrame:
    """symbol, close, prev_close, ret_1d, best first, no prior last (Q2, O2).
    The prior close is exactly one day earlier, so Mondays have none (T14)."""
    s = with_symbol(snapshot(bars, t), dims)
    return (s.select("symbol", "close", "prev_close",
                     simple_return("close", "prev_close").alias("ret_1d"))
            .orderBy(F.col("ret_1d").desc_nulls_last(), F.col("symbol")))


def cross_section_sector(bars: DataFrame, instruments: DataFrame, t,
                         sector: str | None = None) -> DataFrame:
    """The app form: sector, prices to 2 places, return in percent to 3,
    sorted by the rounded return (Q2b, F4, P10). ``instruments`` carries
    (ticker_id, symbol, sector) from the ticker -> industry -> sector chain."""
    d = bounded_broadcast(instruments.select("ticker_id", "symbol", "sector"))
    s = snapshot(bars, t).join(d, "ticker_id")
    ret = simple_return("close", "prev_close") * F.lit(100)
    out = s.select("symbol", "sector", round_dec("close", 2).alias("close"),
                   round_dec("prev_close", 2).alias("prev_close"),
                   round_dec(ret, 3).alias("ret_1d_pct"))
    return by_sector(out, sector).orderBy(F.col("ret_1d_pct").desc_nulls_last(),
                                          F.col("symbol"))
