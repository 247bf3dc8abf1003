"""Numeric helpers.

Division and logarithms return null where Postgres would raise, and rounding
goes through DECIMAL so half-way cases round the way the reference's
``ROUND(x::numeric, n)`` does (traps T3-T5).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(a, b) -> Column:
    """a / b, null when b is zero or null (T4)."""
    return F.try_divide(_c(a), F.nullif(_c(b), F.lit(0)))


def simple_return(last, first) -> Column:
    """last / first - 1.0."""
    return safe_div(last, first) - F.lit(1.0)


def log_return(close, prev) -> Column:
    """ln(close / prev); null unless the ratio is positive (F1, T5)."""
    ratio = safe_div(close, prev)
    return F.when(ratio > 0, F.ln(ratio))


def round_dec(col, n: int) -> Column:
    """ROUND(x::numeric, n) as DECIMAL(18+n... , n) then DOUBLE.

    The value goes through DECIMAL(38,15) so rounding is decimal half-up, not
    binary; the result is a DOUBLE equal to the rounded decimal.
    """
    d = _c(col).cast("decimal(38,15)")
    return F.round(d, n).cast(f"decimal(38,{n})").cast("double")


def round6(col) -> Column:
    """Round an order-dependent double (sums, logs) to 6 places."""
    return round_dec(col, 6)


def int_or_null(col) -> Column:
    """Integer parse that yields null for '', 'x' and other junk."""
    return F.trim(_c(col)).try_cast("bigint")


def num_or(col, default, dtype: str = "double") -> Column:
    """Coerced number with a default for null or junk."""
    return F.coalesce(_c(col).cast("string").try_cast(dtype), F.lit(default).cast(dtype))


def steady_sum(x) -> Column:
    """Sum of doubles that does not depend on the order of the rows.

    Whole units, the rest in steps of 2^-30 and what that leaves in steps of
    2^-60 are summed apart: the sums are exact up to 2^53 units and 2^23 rows.
    Beyond that the last digits depend on the order, as with any sum of doubles.
    """
    c = F.col(x) if isinstance(x, str) else x
    step = float(1 << 30)
    rest = (c - F.rint(c)) * step
    last = (rest - F.rint(rest)) * step
    return F.sum(F.rint(c)) + (F.sum(F.rint(rest)) + F.sum(F.rint(last)) / step) / step
