"""Row filters on bar and rollup tables.

Time filters are written so they reach the Parquet scan: the UTC range on
``ts`` becomes a pushed filter (row-group min/max skipping) and, when the
table carries the ``month`` partition column, a month predicate is added
so whole folders are pruned (the reference's partition pruning).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise.functions.text import not_blank
from barwise.functions.timefn import (NEW_YORK, date_lit, hhmm_int, hhmm_to_minute,
                                      in_half_open, local_hhmm, minute_of_day, month_key,
                                      prior_day, ts_lit, utc_window, weekday)

MONTH_COL = "month"


def _ts(value) -> Column:
    return value if isinstance(value, Column) else ts_lit(value)


def _month_keys(t0, t1) -> list[str] | None:
    """Month keys covering [t0, t1) when both ends are literals."""
    if isinstance(t0, Column) or isinstance(t1, Column):
        return None
    a = _dt.datetime.fromisoformat(str(t0))
    b = _dt.datetime.fromisoformat(str(t1)) - _dt.timedelta(microseconds=1)
    keys, y, m = [], a.year, a.month
    while (y, m) <= (b.year, b.month):
        keys.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return keys


# Rows outside a table's supported range live in this partition; a month
# predicate must always keep it, or such rows would be pruned away.
DEFAULT_MONTH = "default"


def month_predicate(df: DataFrame, t0, t1) -> Column | None:
    """Partition predicate on ``month`` for the range [t0, t1), or None."""
    if MONTH_COL not in df.columns:
        return None
    keys = _month_keys(t0, t1)
    if keys is not None:
        return F.col(MONTH_COL).isin(keys + [DEFAULT_MONTH])
    m = F.col(MONTH_COL)
    return ((m >= month_key(_ts(t0))) & (m <= month_key(_ts(t1)))) | (m == DEFAULT_MONTH)


DAY_COL = "day"
# Longer literal ranges keep only the month predicate on a day-partitioned table.
MAX_DAY_KEYS = 400


def _day_keys(t0, t1) -> list[str] | None:
    """Day keys covering [t0, t1) when both ends are literals."""
    if isinstance(t0, Column) or isinstance(t1, Column):
        return None
    a = _dt.datetime.fromisoformat(str(t0)).date()
    b = (_dt.datetime.fromisoformat(str(t1)) - _dt.timedelta(microseconds=1)).date()
    n = (b - a).days + 1
    if n > MAX_DAY_KEYS:
        return None
    return [(a + _dt.timedelta(days=i)).isoformat() for i in range(max(n, 0))]


def _day_kind(df: DataFrame) -> str | None:
    """'string' or 'date' for the optional ``day`` partition key. Partition
    discovery reads day=yyyy-MM-dd folders as DATE unless a 'default' folder
    makes the column a string."""
    if DAY_COL not in df.columns:
        return None
    kind = df.schema[DAY_COL].dataType
    if isinstance(kind, T.StringType):
        return "string"
    return "date" if isinstance(kind, T.DateType) else None


def _day_values(df: DataFrame, keys: list) -> list:
    if _day_kind(df) == "string":
        return [*keys, F.lit(DEFAULT_MONTH)]
    return keys


def day_predicate(df: DataFrame, t0, t1) -> Column | None:
    """Partition predicate on the optional ``day`` column, or None."""
    keys = _day_keys(t0, t1) if _day_kind(df) else None
    if keys is None:
        return None
    if _day_kind(df) == "date":
        return F.col(DAY_COL).isin([_dt.date.fromisoformat(k) for k in keys])
    return F.col(DAY_COL).isin(keys + [DEFAULT_MONTH])


def _day_key(df: DataFrame, t: Column) -> Column:
    d = F.to_date(t)
    return d.cast("string") if _day_kind(df) == "string" else d


def time_range(bars: DataFrame, t0, t1, ts_col: str = "ts") -> DataFrame:
    """Half-open UTC range ``t0 <= ts < t1`` plus the month (and, on a
    day-partitioned table, day) predicates (P3)."""
    cond = (F.col(ts_col) >= _ts(t0)) & (F.col(ts_col) < _ts(t1))
    for p in (month_predicate(bars, t0, t1), day_predicate(bars, t0, t1)):
        if p is not None:
            cond = cond & p
    return bars.where(cond)


def at_time(bars: DataFrame, t, ts_col: str = "ts") -> DataFrame:
    """Bars at one bar time."""
    cond = F.col(ts_col) == _ts(t)
    if MONTH_COL in bars.columns:
        cond = cond & F.col(MONTH_COL).isin(month_key(_ts(t)), F.lit(DEFAULT_MONTH))
    if _day_kind(bars):
        cond = cond & F.col(DAY_COL).isin(*_day_values(bars, [_day_key(bars, _ts(t))]))
    return bars.where(cond)


def at_times(bars: DataFrame, times: list, ts_col: str = "ts") -> DataFrame:
    """Bars at any of a few bar times, one scan."""
    cols = [_ts(t) for t in times]
    cond = F.col(ts_col).isin(*cols)
    if MONTH_COL in bars.columns:
        cond = cond & F.col(MONTH_COL).isin(*[month_key(c) for c in cols], F.lit(DEFAULT_MONTH))
    if _day_kind(bars):
        cond = cond & F.col(DAY_COL).isin(*_day_values(bars, [_day_key(bars, c) for c in cols]))
    return bars.where(cond)


def with_prior_day(t) -> list:
    return [_ts(t), prior_day(_ts(t))]


def date_range(daily: DataFrame, d0, d1, col: str = "session_date") -> DataFrame:
    """Half-open date range (P5)."""
    c0 = d0 if isinstance(d0, Column) else date_lit(d0)
    c1 = d1 if isinstance(d1, Column) else date_lit(d1)
    cond = (F.col(col) >= c0) & (F.col(col) < c1)
    if MONTH_COL in daily.columns and not isinstance(d0, Column) and not isinstance(d1, Column):
        keys = _month_keys(f"{d0} 00:00:00", f"{d1} 00:00:00")
        cond = cond & F.col(MONTH_COL).isin(keys + [DEFAULT_MONTH])
    return daily.where(cond)


def regular_hours_cond(ts_col: str = "ts", tz: str = NEW_YORK, open_: str = "09:30",
                       close: str = "16:00") -> Column:
    """open <= local clock < close, with one time zone conversion per row."""
    lo, hi = hhmm_to_minute(open_), hhmm_to_minute(close)
    if lo >= hi:
        raise ValueError("session close must be after its open")
    local = in_half_open(local_hhmm(ts_col, tz), hhmm_int(open_), hhmm_int(close))
    window = utc_window(tz, lo, hi)
    if window is None:
        return local
    # A zone-free test on the UTC clock first: AND short-circuits, so only
    # rows inside the UTC window pay for the time zone conversion.
    a, b = window
    m = minute_of_day(ts_col)
    utc = in_half_open(m, a, b) if a < b else (m >= a) | (m < b)
    return utc & local


def regular_hours(bars: DataFrame, tz: str = NEW_YORK, open_: str = "09:30",
                  close: str = "16:00", ts_col: str = "ts") -> DataFrame:
    """Bars whose local start lies in [open, close) (P6): end excluded,
    daylight saving through the zone name, early closes ignored (T18)."""
    return bars.where(regular_hours_cond(ts_col, tz, open_, close))


def symbol_ids(dims: DataFrame, symbols) -> list[tuple[int, str]]:
    """(ticker_id, symbol) of the named symbols: a read of the instrument
    list bounded by the names asked for."""
    syms = [symbols] if isinstance(symbols, str) else list(symbols)
    rows = dims.where(F.col("symbol").isin(syms)).select("ticker_id", "symbol")
    return sorted({(r[0], r[1]) for r in rows.collect()})


def for_symbol(bars: DataFrame, dims: DataFrame, symbols) -> DataFrame:
    """Bars of one or several symbols (P2, P11), with their symbol.

    The symbols are looked up first, so the fact carries a literal
    ``ticker_id IN (...)`` that reaches the Parquet scan (row groups sorted
    by instrument are skipped) and there is no join.
    """
    found = symbol_ids(dims, symbols)
    ids = sorted({i for i, _ in found})
    mine = bars.where(F.col("ticker_id").isin(ids)) if ids else bars.where(F.lit(False))
    by_id: dict = {}
    for i, s in found:
        by_id.setdefault(i, []).append(s)
    names = F.array().cast("array<string>")
    for i, s in by_id.items():
        names = F.when(F.col("ticker_id") == i, F.array(*[F.lit(x) for x in sorted(s)])).otherwise(names)
    if all(len(s) == 1 for s in by_id.values()):
        return mine.withColumn("symbol", F.get(names, F.lit(0)))
    return mine.withColumn("symbol", F.explode(names))


def by_sector(df: DataFrame, sector: str | None = None, col: str = "sector") -> DataFrame:
    """Optional sector filter; None or '(all)' keeps everything (P10)."""
    if sector is None or sector == "(all)":
        return df
    return df.where(F.col(col) == sector)


def in_range_cond(ts_col: str, start, end) -> Column:
    return (F.col(ts_col) >= _ts(start)) & (F.col(ts_col) < _ts(end))


def clip_range(bars: DataFrame, start, end, ts_col: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Split into (kept, dropped) by the supported range [start, end)."""
    cond = in_range_cond(ts_col, start, end)
    return bars.where(cond), bars.where(~cond)


def drop_blank_symbols(df: DataFrame, col: str = "symbol") -> DataFrame:
    """Skip rows whose symbol is empty or blank."""
    return df.where(not_blank(col))


def weekdays_only(daily: DataFrame, col: str = "session_date") -> DataFrame:
    """Monday to Friday."""
    return daily.where(weekday(col) < 5)


def loaded_bounds(lo, hi, min_allowed, max_allowed) -> tuple[Column, Column]:
    """Clamp a pair of bounds into the supported range (P20)."""
    return (F.greatest(lo, min_allowed), F.least(hi, max_allowed))


def choose_grain(d0: str, d1: str, grain: str | None = None, max_raw_days: int = 5) -> str:
    """'daily' when the range is longer than ``max_raw_days`` days, else
    'raw' (P21). A driver-side choice between two lazy plans."""
    if grain in ("raw", "daily"):
        return grain
    a = _dt.date.fromisoformat(str(d0)[:10])
    b = _dt.date.fromisoformat(str(d1)[:10])
    if b <= a:
        raise ValueError("'to' must be after 'from'")
    return "daily" if (b - a).days > max_raw_days else "raw"
