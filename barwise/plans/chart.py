"""Chart queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions.timefn import NEW_YORK, local_label, to_local
from barwise.operators.filters import (choose_grain, date_range, for_symbol, regular_hours,
                                       time_range, weekdays_only)

BAR_OUT = ["ts", "open", "high", "low", "close", "volume"]


def ticker_chart(bars: DataFrame, dims: DataFrame, symbol: str, t0, t1,
                 with_vwap: bool = True) -> DataFrame:
    """Bars of one instrument in [t0, t1), oldest first (Q1)."""
    b = for_symbol(time_range(bars, t0, t1), dims, symbol)
    return b.select(*BAR_OUT, *(["vwap"] if with_vwap else [])).orderBy("ts")


def session_sample(bars: DataFrame, dims: DataFrame, symbol: str, t0, t1,
                   n: int = 10) -> DataFrame:
    """The first ``n`` bars of one instrument in a session window (O4):
    a top-N sort (TakeOrderedAndProject), not a full sort."""
    return ticker_chart(bars, dims, symbol, t0, t1, with_vwap=False).limit(n)


def chart_local(bars: DataFrame, dims: DataFrame, symbol: str, t0, t1, tz: str = NEW_YORK,
                rth_only: bool = True) -> DataFrame:
    """Bars with local time and an axis label, regular hours only by
    default (P6, F6, F17): the app's client-side filter done in the job."""
    b = for_symbol(time_range(bars, t0, t1), dims, symbol)
    if rth_only:
        b = regular_hours(b, tz)
    return (b.select("ts", to_local("ts", tz).alias("ts_local"),
                     local_label("ts", tz).alias("label"), "open", "high", "low", "close",
                     "volume").orderBy("ts"))


def daily_chart(daily: DataFrame, dims: DataFrame, symbol: str, d0, d1,
                with_vwap: bool = True) -> DataFrame:
    """Daily bars of one instrument from the stored rollup."""
    d = for_symbol(date_range(daily, d0, d1), dims, symbol)
    cols = [F.col("session_date").alias("day"), "open", "high", "low", "close", "volume"]
    return d.select(*cols, *(["vwap"] if with_vwap else [])).orderBy("day")


def chart(bars: DataFrame, daily: DataFrame, dims: DataFrame, symbol: str, d0: str, d1: str,
          grain: str | None = None, weekdays: bool = True) -> tuple[str, DataFrame]:
    """Raw bars for short ranges, daily bars when the range is longer than
    five days (P21); the daily view hides weekends (P19)."""
    g = choose_grain(d0, d1, grain)
    if g == "raw":
        return g, ticker_chart(bars, dims, symbol, f"{d0} 00:00:00", f"{d1} 00:00:00")
    d = daily_chart(daily, dims, symbol, d0, d1)
    if weekdays:
        d = weekdays_only(d, "day")
    return g, d
