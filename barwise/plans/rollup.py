"""Daily rollup and its maintained table.

``daily_rollup`` is the reference's materialized view as a grouped
aggregate: regular-hours bars (09:30-16:00 local, end excluded, daylight
saving through the zone) per (instrument, local date). The stored table is
Parquet partitioned by ``month`` of the session date; ``refresh_daily``
rebuilds only the months asked for and replaces just those folders.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions.timefn import (NEW_YORK, hhmm_to_minute, local_date, month_key,
                                      session_date)
from barwise.operators.bars import ohlcv_from_bars
from barwise.operators.filters import for_symbol, regular_hours, time_range
from barwise.sinks.layout import cluster
from barwise.sinks.tables import PlainTable, open_table, read_table_at

DAILY_COLS = ["ticker_id", "session_date", "open", "high", "low", "close", "volume", "vwap",
              "trade_count"]


def rollup(bars: DataFrame, period: str = "day", tz: str = NEW_YORK,
           session: tuple[str, str] | None = ("09:30", "16:00"), key: str = "ticker_id",
           ts: str = "ts") -> DataFrame:
    """OHLCV per instrument and local ``period`` ('day', 'week', 'month').

    ``session`` limits bars to a local clock range (None keeps all).
    Output: key, session_date (period start), open ... trade_count.
    """
    if session:
        b = regular_hours(bars, tz, session[0], session[1], ts)
        d = session_date(ts, tz, hhmm_to_minute(session[0]), hhmm_to_minute(session[1]))
    else:
        b, d = bars, local_date(ts, tz)
    if period != "day":
        d = F.trunc(d, period)
    return (b.groupBy(key, d.alias("session_date")).agg(*ohlcv_from_bars(ts))
            .select(key, "session_date", *DAILY_COLS[2:]))


def daily_rollup(bars: DataFrame, tz: str = NEW_YORK, open_: str = "09:30",
                 close: str = "16:00") -> DataFrame:
    """bar_1d for all instruments."""
    return rollup(bars, "day", tz, (open_, close))


def daily_rollup_for(bars: DataFrame, dims: DataFrame, symbol: str, t0, t1,
                     tz: str = NEW_YORK) -> DataFrame:
    """Q9: daily OHLCV of one instrument from raw bars in [t0, t1)."""
    b = for_symbol(time_range(bars, t0, t1), dims, symbol).drop("symbol")
    d = daily_rollup(b, tz)
    return (d.select(F.col("session_date").alias("day"), "open", "high", "low", "close",
                     "volume").orderBy("day"))


def _with_month(daily: DataFrame) -> DataFrame:
    return daily.withColumn("month", month_key("session_date"))


def _clustered(daily: DataFrame) -> DataFrame:
    """Range-partitioned by (month, ticker_id, session_date) and sorted, so
    each month folder gets a few large files sorted by instrument (not one
    small file per task and month, as a hash exchange would give)."""
    return cluster(daily, part="month", key="ticker_id", ts="session_date")


def build_daily(bars: DataFrame, path: str | PlainTable, **kw) -> None:
    """M1/M2: write the full rollup, partitioned by session month. The stored
    table is replaced whole, months without bars included. It is staged first,
    so a lost job leaves the old table; a versioned table changes at once."""
    table = open_table(bars.sparkSession, path)
    table.publish(table.stage(_clustered(_with_month(rollup(bars, **kw)))), "truncate")


def _location(uri: str) -> tuple[str, str]:
    """(host or bucket, normalised path) of a file URI or plain path."""
    u = urlparse(uri)
    return u.netloc, posixpath.normpath(u.path or uri)


def reads_from(df: DataFrame, path: str) -> bool:
    """True when any input file of ``df`` lies under ``path``."""
    host, root = _location(path)
    for f in df.inputFiles():
        h, p = _location(f)
        if h == host and (p == root or p.startswith(root + "/")):
            return True
    return False


def refresh_daily(bars: DataFrame, path: str | PlainTable, months: Sequence[str], **kw) -> None:
    """M3: recompute the listed session months from bars and replace only
    those partitions; listed months without bars go. The rollup is computed
    from bars, never from the table being replaced (refused), and staged
    first, so a lost job leaves the old table.

    Bars are read one day on either side of each month, so sessions whose
    UTC bars straddle a month edge are complete; then only session dates in
    the months are kept.
    """
    table = open_table(bars.sparkSession, path)
    if reads_from(bars, table.path):
        raise ValueError("refresh_daily: bars are read from the table being refreshed")
    months = sorted(set(months))
    if not months:
        return
    first = _dt.date.fromisoformat(months[0] + "-01")
    y, m = (int(x) for x in months[-1].split("-"))
    after = _dt.date(y + m // 12, m % 12 + 1, 1)
    lo = f"{first - _dt.timedelta(days=1)} 00:00:00"
    hi = f"{after + _dt.timedelta(days=1)} 00:00:00"
    # Literal bounds: a month-partitioned bar table is pruned to these months.
    near = time_range(bars, lo, hi)
    if "month" in bars.columns:
        around = set()
        for name in months:
            y, m = (int(x) for x in name.split("-"))
            around |= {name, f"{y - (m == 1)}-{(m + 10) % 12 + 1:02d}", f"{y + (m == 12)}-{m % 12 + 1:02d}"}
        near = near.where(F.col("month").isin(sorted(around) + ["default"]))
    d = _with_month(rollup(near, **kw)).where(F.col("month").isin(months))
    table.publish(table.stage(_clustered(d)), "overwrite", drop=months)


def read_rollup(spark: SparkSession, path: str | PlainTable) -> DataFrame:
    return read_table_at(spark, path)


def digests(df: DataFrame, by: Column) -> DataFrame:
    """(_by, rows, d1, d2) for each value of ``by``: sums of two hashes of the
    rows, the same in any order of the rows. Tables whose digests agree differ
    with a chance of about 2^-128."""
    add = lambda seed: F.sum(F.xxhash64(F.lit(seed), *df.columns).cast("decimal(38,0)"))
    return df.groupBy(by.alias("_by")).agg(F.count(F.lit(1)).alias("rows"), add(1).alias("d1"), add(2).alias("d2"))


def differing(a: DataFrame, b: DataFrame, by: Column) -> DataFrame:
    """(_by): the values of ``by`` whose rows are not the same on both sides."""
    both = digests(a, by).withColumn("_side", F.lit(1)).unionByName(digests(b.select(*a.columns), by).withColumn("_side", F.lit(2)))
    # A value is equal if both sides have one row each, with the same digest.
    same = (F.count(F.lit(1)) == 2) & (F.min("rows") == F.max("rows")) & (F.min("d1") == F.max("d1")) & (F.min("d2") == F.max("d2"))
    return both.groupBy("_by").agg(same.alias("_same")).where("not _same").select("_by")


def compare(a: DataFrame, b: DataFrame, by: Column | None = None) -> DataFrame:
    """M5: rows only in a and rows only in b (multiset difference), one row.

    With ``by`` (such as the month, few values), digests are compared first
    and only the rows of differing values are shuffled and matched.
    """
    cols = a.columns
    b = b.select(*cols)
    if by is not None:
        off = differing(a, b, by)
        # Null values of ``by`` are compared like others.
        only = lambda df: df.withColumn("_key", by).join(off, F.col("_key").eqNullSafe(F.col("_by")), "left_semi").select(*cols)
        a, b = only(a), only(b)
    only_a = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_left"))
    only_b = b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_right"))
    return only_a.unionByName(only_b, allowMissingColumns=True).agg(
        F.max("only_left").alias("only_left"), F.max("only_right").alias("only_right"))
