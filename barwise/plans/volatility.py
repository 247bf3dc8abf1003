"""Rolling realized volatility.

Computed for every instrument at once over blocked windows (see
``operators.windows``), so a long or hot instrument is split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from barwise.operators.filters import for_symbol, time_range
from barwise.operators.joins import with_symbol
from barwise.operators.windows import BLOCK_ROWS, rolling_vol


def volatility_scan(bars: DataFrame, dims: DataFrame, n: int = 20, drop_first: bool = False,
                    t0=None, t1=None, symbol: str | None = None,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """symbol, ts, rv over the last ``n`` bars (Q6: first bar null, Q6b:
    ``drop_first`` removes it and the frame never counts it)."""
    b = bars if t0 is None else time_range(bars, t0, t1)
    if symbol is not None:
        b = for_symbol(b, dims, symbol).drop("symbol")
    rv = rolling_vol(b, n, drop_first, block_rows=block_rows)
    return with_symbol(rv, dims).select("symbol", "ts", "rv")
