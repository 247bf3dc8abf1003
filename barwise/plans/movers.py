"""Top movers in a time window.

The reference computes FIRST_VALUE / LAST_VALUE over an unbounded window
and de-duplicates; here it is one grouped aggregate with min_by / max_by,
partially aggregated on the map side, and a TakeOrderedAndProject for the
top N. Ties are broken by symbol (T7); null returns are dropped (T6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions.numeric import round_dec, simple_return
from barwise.functions.timefn import NEW_YORK, local_window
from barwise.operators.filters import time_range
from barwise.operators.joins import with_symbol
from barwise.operators.windows import first_last, first_last_window


def movers(bars: DataFrame, dims: DataFrame, t0, t1, form: str = "group") -> DataFrame:
    """Every instrument's first open, last close, volume and return in [t0, t1).

    ``form="window"`` uses the reference's window-plus-DISTINCT form, for
    comparison only."""
    w = time_range(bars, t0, t1)
    fl = first_last_window(w) if form == "window" else first_last(w)
    fl = fl.withColumn("ret", simple_return("last_close", "first_open"))
    return with_symbol(fl, dims)


def top_movers(bars: DataFrame, dims: DataFrame, t0, t1, n: int = 20,
               with_volume: bool = False, form: str = "group") -> DataFrame:
    """Top ``n`` by return: symbol and ret_pct (Q3); with ``with_volume`` also
    rounded open and close and summed volume (Q3b)."""
    m = movers(bars, dims, t0, t1, form).where(F.col("ret").isNotNull())
    cols = [F.col("symbol"), round_dec(F.col("ret") * F.lit(100), 3).alias("ret_pct")]
    if with_volume:
        cols += [round_dec("first_open", 2).alias("open"),
                 round_dec("last_close", 2).alias("close"), F.col("vol_sum").alias("volume")]
    top = m.orderBy(F.col("ret").desc(), F.col("symbol").asc()).limit(n)
    return top.select(*cols)


def top_movers_local(bars: DataFrame, dims: DataFrame, day, start: str, end: str,
                     n: int = 20, tz: str = NEW_YORK, with_volume: bool = True) -> DataFrame:
    """The same window given as a local date and clock times."""
    t0, t1 = local_window(day, start, end, tz)
    return top_movers(bars, dims, t0, t1, n, with_volume)
