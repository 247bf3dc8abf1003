"""One sort key from two columns: the bits of their ranks in turn (a Z-order curve)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of each rank: 4096 steps of the key and of the time within a month (some 11 minutes).
BITS = 12
MONTH_SECONDS = 31 * 86400


def _spread(x: Column) -> Column:
    """The lowest 16 bits of ``x`` with a zero bit before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def _step(x: Column, whole) -> Column:
    """The place of ``x`` in [0, whole) as one of 2^BITS steps; what lies outside counts as an end."""
    inside = F.least(F.greatest(x.cast("long"), F.lit(0)), F.lit(whole - 1))
    return F.floor(inside * (1 << BITS) / whole).cast("long")


def curve_key(key: Column, ts: Column, keys: int) -> Column:
    """Place of (key, ts) on the curve through the keys 0 to ``keys`` and the times of a month.

    Neighbours on the curve are near in both, so a range of it covers few keys and a short
    time. Keys outside the bounds count as the nearest; a null key or time comes first (null).
    """
    seconds = (F.dayofmonth(ts) - 1) * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    by_key, by_time = _step(key, keys + 1), _step(seconds, MONTH_SECONDS)
    return _spread(by_key).bitwiseOR(F.shiftleft(_spread(by_time), 1))
