"""Time functions on zone-free UTC bar times.

All inputs and outputs are TIMESTAMP_NTZ in UTC wall clock unless a name
says "local". ``convert_timezone`` works on NTZ values directly, so nothing
here depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt
import functools
import zoneinfo

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_lit(value) -> Column:
    """A UTC bar time literal from 'YYYY-MM-DD[ HH:MM[:SS]]' or a naive datetime."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    return F.lit(str(value)).cast("date")


def to_local(ts, tz: str = NEW_YORK) -> Column:
    """UTC instant to the wall clock of ``tz``, daylight saving included."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


def to_utc(local_ts, tz: str = NEW_YORK) -> Column:
    """Wall clock of ``tz`` to the UTC instant."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(local_ts))


def local_date(ts, tz: str = NEW_YORK) -> Column:
    """Calendar date in ``tz``."""
    return F.to_date(to_local(ts, tz))


EPOCH_NTZ = "1970-01-01 00:00:00"

# Codegen does not share a repeated sub-expression inside one filter, and a
# time zone conversion costs about a microsecond per row; so the functions
# below reference their (possibly converted) input exactly once.


def minute_of_day(ts) -> Column:
    """Minute of the day of a TIMESTAMP_NTZ, read from its fields (no
    session time zone involved). Meant for plain columns: ``ts`` is
    referenced twice."""
    c = _c(ts)
    return F.hour(c) * 60 + F.minute(c)


def local_minute(ts, tz: str = NEW_YORK) -> Column:
    """Minute of the day in ``tz``."""
    return minute_of_day(to_local(ts, tz))


def local_hhmm(ts, tz: str = NEW_YORK) -> Column:
    """Local clock as an HHmm integer (09:30 -> 930) from a single time zone
    conversion, cut from the NTZ text (the cast is zone-free)."""
    return F.translate(F.substring(_text(to_local(ts, tz)), 12, 5), ":", "").cast("int")


def hhmm_int(hhmm: str) -> int:
    """'09:30' -> 930, the form ``local_hhmm`` compares against."""
    h, m = hhmm.split(":")[:2]
    return int(h) * 100 + int(m)


def in_half_open(value: Column, lo: int, hi: int) -> Column:
    """lo <= value < hi with a single reference to ``value`` (lo < hi)."""
    return F.floor((value - F.lit(lo)) / F.lit(hi - lo)) == 0


@functools.lru_cache(maxsize=64)
def zone_offsets(tz: str) -> tuple[int, int]:
    """(min, max) UTC offset of ``tz`` in minutes over 1900-2100, sampled
    daily at noon (enough to see every standard and daylight offset)."""
    zone = zoneinfo.ZoneInfo(tz)
    day = _dt.datetime(1900, 1, 1, 12)
    seen = set()
    while day.year <= 2100:
        seen.add(int(zone.utcoffset(day).total_seconds() // 60))
        day += _dt.timedelta(days=1)
    return min(seen), max(seen)


def utc_window(tz: str, lo: int, hi: int) -> tuple[int, int] | None:
    """UTC minute-of-day range [a, b) (wrapping past midnight when a > b)
    that contains every instant whose ``tz`` clock is in [lo, hi); None
    when it would cover the whole day."""
    lo_off, hi_off = zone_offsets(tz)
    start, end = lo - hi_off, hi - lo_off
    if end - start >= 1440:
        return None
    return start % 1440, end % 1440


def same_date_window(tz: str, lo: int, hi: int) -> bool:
    """True when every instant whose ``tz`` clock is in [lo, hi) has the same
    calendar date in UTC as in ``tz`` (e.g. New York's 09:30-16:00), so the
    local session date can be read from the UTC value without conversion."""
    window = utc_window(tz, lo, hi)
    if window is None or window[0] >= window[1]:
        return False
    a, b = window
    lo_off, hi_off = zone_offsets(tz)
    return a + lo_off >= 0 and b - 1 + hi_off < 1440


def session_date(ts, tz: str, lo: int, hi: int) -> Column:
    """Local date of a bar already known to lie in the [lo, hi) session of
    ``tz``: ``to_date(ts)`` when that is provably the same, else converted."""
    return F.to_date(_c(ts)) if same_date_window(tz, lo, hi) else local_date(ts, tz)


def _text(ts) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of a TIMESTAMP_NTZ (the cast is zone-free)."""
    return _c(ts).cast("timestamp_ntz").cast("string")


def local_time(ts, tz: str = NEW_YORK) -> Column:
    """Time of day in ``tz`` as 'HH:mm:ss' (F7)."""
    return F.substring(_text(to_local(ts, tz)), 12, 8)


def local_label(ts, tz: str = NEW_YORK) -> Column:
    """Local time as text 'yyyy-MM-dd HH:mm' for a chart axis.

    Cut from the NTZ value's text rather than ``date_format``, which would
    pass the value through the session time zone."""
    return F.substring(_text(to_local(ts, tz)), 1, 16)


def prior_day(ts) -> Column:
    """The same clock time one calendar day earlier (F8)."""
    return _c(ts) - F.expr("INTERVAL 1 DAY")


def next_month(d) -> Column:
    """First day of the following month for a month start."""
    return F.add_months(_c(d), 1)


def month_key(ts) -> Column:
    """Partition key 'yyyy-MM' of a date or time (F10), zone-free."""
    return F.substring(F.to_date(_c(ts)).cast("string"), 1, 7)


def month_start(ts) -> Column:
    return F.trunc(F.to_date(_c(ts)), "month")


def hhmm_to_minute(hhmm: str) -> int:
    h, m = hhmm.split(":")[:2]
    return int(h) * 60 + int(m)


def local_instant(day, clock: str, tz: str = NEW_YORK) -> Column:
    """The UTC instant of a local date and clock time 'HH:MM' in ``tz``
    (e.g. a cross-section at 15:55 New York time). Folded to a literal."""
    return to_utc(F.lit(f"{day} {clock}:00").cast("timestamp_ntz"), tz)


def local_window(day, start: str, end: str, tz: str = NEW_YORK) -> tuple[Column, Column]:
    """A local date and two local clock times as a half-open UTC range."""
    if hhmm_to_minute(end) <= hhmm_to_minute(start):
        raise ValueError("end time must be after start time")
    d = str(day)
    t0 = to_utc(F.lit(f"{d} {start}:00").cast("timestamp_ntz"), tz)
    t1 = to_utc(F.lit(f"{d} {end}:00").cast("timestamp_ntz"), tz)
    return t0, t1


def from_epoch_micros(micros) -> Column:
    """Epoch microseconds to a UTC wall-clock TIMESTAMP_NTZ, zone-free."""
    return F.timestamp_add("MICROSECOND", _c(micros), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def vendor_ts(t) -> Column:
    """Vendor bar time to UTC: epoch nanoseconds (number or digit string) or an
    ISO string; anything else is null (F14).

    An ISO string without an offset is taken as UTC.
    """
    c = F.trim(_c(t))
    digits = c.rlike(r"^[0-9]+$")
    numeric = c.rlike(r"^[0-9]+(\.[0-9]*)?([eE][+]?[0-9]+)?$")
    nanos = F.when(digits, c.try_cast("bigint")).when(
        numeric, c.try_cast("double").try_cast("bigint"))
    date_only = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    has_zone = c.rlike(r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    iso = (F.when(date_only, F.concat(c, F.lit("T00:00:00Z")))
           .when(has_zone, c).otherwise(F.concat(c, F.lit("Z"))))
    micros = F.when(numeric, F.floor(nanos / 1000).cast("bigint")).otherwise(
        F.unix_micros(F.try_to_timestamp(iso)))
    return from_epoch_micros(micros)


def is_early_close(close_ts, cutoff: str = "19:30") -> Column:
    """Early-close flag: a session that closes before ``cutoff`` UTC."""
    return minute_of_day(close_ts) < hhmm_to_minute(cutoff)


def weekday(d) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(d))
