"""Market-wide volume per bar time (Q10)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barwise.operators.aggregates import market_volume as _market_volume
from barwise.operators.filters import time_range


def market_volume(bars: DataFrame, t0, t1) -> DataFrame:
    """ts, dollar_volume, share_volume, bars for [t0, t1), by ts (Q10)."""
    return _market_volume(time_range(bars, t0, t1)).orderBy("ts")
