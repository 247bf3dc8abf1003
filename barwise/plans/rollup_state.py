"""Daily rollup kept as mergeable states (M3).

A rolled-up day is stored as what two parts of it need to become one: the
first and last price with their times, the extremes, and the sums. New bars
are reduced to states of their own and merged with the stored states of the
months they fall in, one row per instrument and day. No bar that was rolled
up before is read again, whatever else the month holds.

Sums can't tell a bar that comes twice from a new one: a batch must hold new
bars only (``sinks.merge.new_rows``), and each batch is numbered, so that one
that is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.functions.timefn import NEW_YORK, hhmm_to_minute, local_date, month_key, session_date
from barwise.operators.bars import bar_dollars
from barwise.operators.filters import regular_hours
from barwise.plans.rollup import DAILY_COLS
from barwise.sinks.layout import cluster
from barwise.sinks.tables import VersionedTable

KEYS = ["ticker_id", "session_date"]
STATE = ["first_ts", "open", "high", "low", "last_ts", "close", "volume", "dollars", "trade_count"]


def _merged() -> list[Column]:
    """Aggregates that turn states of one day into one; every buffer has a fixed width."""
    return [F.min("first_ts").alias("first_ts"), F.min_by("open", "first_ts").alias("open"),
            F.max("high").alias("high"), F.min("low").alias("low"),
            F.max("last_ts").alias("last_ts"), F.max_by("close", "last_ts").alias("close"),
            F.sum("volume").alias("volume"), F.sum("dollars").alias("dollars"),
            F.sum("trade_count").alias("trade_count")]


def states(bars: DataFrame, tz: str = NEW_YORK, session: tuple[str, str] | None = ("09:30", "16:00"),
           key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """ticker_id, session_date and the state of each instrument's local day."""
    if session:
        b = regular_hours(bars, tz, session[0], session[1], ts)
        day = session_date(ts, tz, hhmm_to_minute(session[0]), hhmm_to_minute(session[1]))
    else:
        b, day = bars, local_date(ts, tz)
    b = b.select(F.col(key).alias("ticker_id"), day.alias("session_date"), F.col(ts).alias("first_ts"), "open", "high", "low",
                 F.col(ts).alias("last_ts"), "close", "volume", bar_dollars().alias("dollars"), "trade_count")
    return b.groupBy(*KEYS).agg(*_merged())


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """States of both sides, one per instrument and day."""
    cols = [*KEYS, *STATE]
    return a.select(*cols).unionByName(b.select(*cols)).groupBy(*KEYS).agg(*_merged())


def finished(state: DataFrame) -> DataFrame:
    """The daily bars of states, with vwap over the whole volume (zero guard as in the rollup)."""
    vwap = F.try_divide("dollars", F.nullif("volume", F.lit(0)).cast("double"))
    return state.withColumn("vwap", vwap).select(*DAILY_COLS)


def apply_bars(table: VersionedTable, bars: DataFrame, batch: int, source: str = "", **kw) -> bool:
    """Merge the states of new ``bars`` into ``table``; False if batch number ``batch`` is in it already.

    Batches of a ``source`` (such as a stream's checkpoint) come in ascending
    numbers; another source starts anew. Only the states of the months that the
    batch falls in are read and replaced; they and the number are published
    by one rename, so a batch is in the table whole or not at all.
    """
    base = table.version()
    done = table.manifest(base).get("note") or {}
    if done.get("source") == source and batch <= done["batch"]:
        return False
    fresh = states(bars, **kw).withColumn("month", month_key("session_date"))
    if base:
        months = [r.month for r in fresh.select("month").distinct().collect()]  # bounded by the calendar
        fresh = merge(fresh, table.read(base).where(F.col("month").isin(months))).withColumn("month", month_key("session_date"))
    staged = table.stage(cluster(fresh, part="month", key="ticker_id", ts="session_date"))
    table.publish(staged, "overwrite", base=base, note={"source": source, "batch": batch})
    return True
