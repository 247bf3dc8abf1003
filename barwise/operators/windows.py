"""Per-instrument window work (W1-W7) that stays bounded for hot instruments.

A window partitioned by instrument alone puts an instrument's whole history
into one task; one instrument may hold a third of the rows. The row-frame
windows here (lag, rolling sums) run over chunks of time instead:

1. Rows are dealt by (instrument, chunk). A chunk is the coarsest of year,
   month, day, hour, minute and second in which an instrument can have no more
   than ``block_rows`` bars of the declared width: a bound from the bars' own
   grid, so nothing is counted first and building a query starts no job.
2. Inside a chunk every row whose whole frame lies in it is done.
3. The rows at the edges of the chunks, at most ``2 n + 2`` each, are put
   together per instrument; there the first rows of a chunk meet the last ones
   of those before, which is all that their frames need. How many meet
   depends on the calendar and the frame, not on the number of rows.

One shuffle of the rows, one of the edges. Results equal the plain
per-instrument window row for row; that one is planned where the files read
are too small (``ROW_BYTES`` for each of ``block_rows`` rows, by the plan's
size statistic) for an instrument to matter.

Rows off the grid (ticks, several rows a bar) make chunks larger, never wrong.
For such tables ``counted=True`` first counts rows per chunk and cuts blocks
by position (``block_table``): exact block sizes, at the price of a pass.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwise.functions.numeric import log_return
from barwise.operators.joins import plan_bytes
from barwise.session import checkpoint_root

BLOCK_ROWS = 1_000_000
GRAINS = ("month", "day", "hour", "minute", "second", "microsecond")


def _chunk(ts: str, grain: str) -> Column:
    """Start of the chunk of time that holds ``ts``."""
    if grain in ("month", "day"):
        return F.trunc(F.to_date(F.col(ts)), "month") if grain == "month" else F.to_date(F.col(ts))
    return F.date_trunc(grain, F.col(ts))


@dataclass
class Blocks:
    """The block table of one DataFrame and the grain of its chunks."""

    table: DataFrame  # key, _chunk, _blk, _own
    grain: str


def assign_blocks(counts: DataFrame, halo: int, size: int, key: str = "ticker_id") -> DataFrame:
    """(key, _chunk, _blk, _own): the block(s) each (key, chunk) of ``_n`` rows goes to."""
    start = F.coalesce(F.sum("_n").over(Window.partitionBy(key).orderBy("_chunk")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    c = counts.select(key, "_chunk", start.alias("_start"), (start + F.col("_n")).alias("_end"))
    home = F.floor(F.col("_start") / size)
    reach = F.col("_end") > (home + 1) * size - F.lit(halo)
    targets = (F.when(reach & F.lit(halo > 0), F.array(home, home + 1))
               .otherwise(F.array(home)))
    return c.select(key, "_chunk", home.alias("_home"), F.explode(targets).alias("_blk")) \
        .select(key, "_chunk", "_blk", (F.col("_blk") == F.col("_home")).alias("_own"))


def single_block(df: DataFrame) -> DataFrame:
    """Every row in block 0: the plain per-instrument window."""
    return df.withColumn("_blk", F.lit(0).cast("bigint")).withColumn("_own", F.lit(True))


def block_table(df: DataFrame, halo: int, key: str = "ticker_id", ts: str = "ts",
                block_rows: int = BLOCK_ROWS) -> Blocks | None:
    """The (instrument, chunk) -> block table, or None when no instrument has
    more than ``block_rows`` rows. One count per (instrument, month); finer
    chunks are counted only if a month is too large. Rows that share an
    instrument and a time can't be told apart in order and stay together."""
    checkpoint_root(df.sparkSession)
    for grain in GRAINS:
        counts = (df.groupBy(key, _chunk(ts, grain).alias("_chunk"))
                  .agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True))
        per_key = counts.groupBy(key).agg(F.sum("_n").alias("all"), F.max("_n").alias("most"))
        whole, most = per_key.agg(F.max("all"), F.max("most")).first()
        if (whole or 0) <= block_rows:
            return None
        size = max(1, block_rows // 4)
        if most + halo <= size or grain == GRAINS[-1]:
            # The positions between two blocks must fit one chunk and the halo.
            table = assign_blocks(counts, halo, max(size, most + halo), key)
            return Blocks(table.checkpoint(eager=True), grain)
    return None


def blocked(df: DataFrame, blocks: Blocks | None, key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """Rows tagged with ``_blk`` (their window block) and ``_own`` (False for
    copies that only serve as preceding rows of the next block)."""
    if blocks is None:
        return single_block(df)
    return (df.withColumn("_chunk", _chunk(ts, blocks.grain))
            .join(blocks.table, [key, "_chunk"]).drop("_chunk"))


# Seconds of the chunks, coarsest first.
CHUNKS = {"year": 366 * 86400, "month": 31 * 86400, "day": 86400, "hour": 3600, "minute": 60, "second": 1}
BAR = _dt.timedelta(minutes=1)
ROW_BYTES = 64


def is_small(src: DataFrame, block_rows: int) -> bool:
    """Whether the plan's size statistic is within ``block_rows`` rows; unknown sizes are not."""
    return plan_bytes(src) <= ROW_BYTES * block_rows


def chunk_grain(block_rows: int = BLOCK_ROWS, bar: _dt.timedelta = BAR) -> str:
    """The coarsest chunk in which an instrument has at most ``block_rows`` bars of width ``bar``."""
    fits = [g for g, seconds in CHUNKS.items() if seconds <= block_rows * bar.total_seconds()]
    return fits[0] if fits else "second"


def _calendar_chunk(ts: str, grain: str) -> Column:
    if grain in ("year", "month", "day"):
        day = F.to_date(F.col(ts))
        return day if grain == "day" else F.trunc(day, grain)
    return F.date_trunc(grain, F.col(ts))


def _with_edges(src: DataFrame, key: str, ts: str, grain: str) -> DataFrame:
    """``src`` with _blk (its chunk), _first and _last (of its chunk) and logret (null in a chunk's first row)."""
    w = Window.partitionBy(key, "_blk").orderBy(ts)
    here = F.lit(1)
    return (src.withColumn("_blk", _calendar_chunk(ts, grain))
            .withColumn("_first", F.lag(here).over(w).isNull()).withColumn("_last", F.lead(here).over(w).isNull())
            .withColumn("logret", log_return(F.col("close"), F.lag("close").over(w))))


def _met(edges: DataFrame, key: str, ts: str) -> DataFrame:
    """``edges`` with the returns of the first rows of chunks, from the last rows of the chunks before."""
    w = Window.partitionBy(key).orderBy(ts)
    return edges.withColumn("_prev", F.lag("close").over(w)).withColumn(
        "logret", F.when(F.col("_first"), log_return(F.col("close"), F.col("_prev"))).otherwise(F.col("logret"))).drop("_prev")


def log_returns(bars: DataFrame, key: str = "ticker_id", ts: str = "ts",
                block_rows: int = BLOCK_ROWS, bar: _dt.timedelta = BAR) -> DataFrame:
    """Adds ``logret`` = ln(close / previous close) per instrument.
    The first bar of each instrument has a null return."""
    if is_small(bars, block_rows):
        return _returns(single_block(bars), key, ts).drop("_blk", "_own")
    r = _with_edges(bars, key, ts, chunk_grain(block_rows, bar))
    first = _met(r.where("_first or _last"), key, ts).where("_first")
    return r.where("not _first").unionByName(first).drop("_blk", "_first", "_last")


def rolling_vol(bars: DataFrame, n: int = 20, drop_first: bool = False,
                key: str = "ticker_id", ts: str = "ts",
                block_rows: int = BLOCK_ROWS, bar: _dt.timedelta = BAR, counted: bool = False) -> DataFrame:
    """Rolling realized volatility sqrt(sum(logret^2)) over the last ``n``
    rows per instrument (W4-W7, F2).

    ``drop_first=False`` is the scenario-file form: every bar is kept, the
    first one's frame holds only a null return, so its value is null (T10).
    ``drop_first=True`` is the app form: null returns are removed before the
    frame, so frames never count them (W7). Frames at the start are partial
    (T11). Output: key, ts, logret, rv.
    """
    if n < 1:
        raise ValueError("window must be at least one bar")
    if counted:
        return _rolling_vol_counted(bars, n, drop_first, key, ts, block_rows)
    src = bars.select(key, ts, "close")
    if is_small(src, block_rows):
        return _rolled(_returns(single_block(src), key, ts), n, drop_first, key, ts)
    r = _with_edges(src, key, ts, chunk_grain(block_rows, bar))
    w = Window.partitionBy(key, "_blk").orderBy(ts)
    # _in: rows that frames count here, all but a chunk's first, whose return comes later. _i: their number so far.
    if drop_first:
        r = r.withColumn("_in", ~F.col("_first") & F.col("logret").isNotNull()).where("_in or _first or _last")
        r = r.withColumn("_i", F.sum(F.col("_in").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        r = r.withColumn("_in", ~F.col("_first")).withColumn("_i", F.row_number().over(w) - 1)
    r = r.withColumn("_tail", F.lead(F.lit(1), n).over(w).isNull())
    squares = lambda over: F.sqrt(F.sum(F.col("logret") * F.col("logret")).over(over.rowsBetween(-(n - 1), 0)))
    done = r.withColumn("rv", squares(w)).where(F.col("_in") & (F.col("_i") >= n))
    edges = _met(r.where(F.col("_first") | F.col("_last") | F.col("_tail") | (F.col("_i") < n)), key, ts)
    if drop_first:
        edges = edges.where(F.col("logret").isNotNull())
    late = F.col("_first") | (F.col("_in") & (F.col("_i") < n))
    edges = edges.withColumn("rv", squares(Window.partitionBy(key).orderBy(ts))).where(late)
    cols = (key, ts, "logret", "rv")
    return done.select(*cols).unionByName(edges.select(*cols))


def _returns(b: DataFrame, key: str, ts: str) -> DataFrame:
    w = Window.partitionBy(key, "_blk").orderBy(ts)
    return (b.withColumn("_prev", F.lag("close").over(w))
            .withColumn("logret", log_return(F.col("close"), F.col("_prev"))).drop("_prev"))


def _rolled(r: DataFrame, n: int, drop_first: bool, key: str, ts: str) -> DataFrame:
    """Sums over frames of rows with ``logret`` in whole blocks."""
    frame = Window.partitionBy(key, "_blk").orderBy(ts).rowsBetween(-(n - 1), 0)
    r = r.where(F.col("logret").isNotNull()) if drop_first else r
    r = r.withColumn("rv", F.sqrt(F.sum(F.col("logret") * F.col("logret")).over(frame)))
    return r.where("_own").select(key, ts, "logret", "rv")


def _rolling_vol_counted(bars: DataFrame, n: int, drop_first: bool, key: str, ts: str, block_rows: int) -> DataFrame:
    """``rolling_vol`` over blocks of counted rows, each with the rows before it that its frames reach."""
    src = bars.select(key, ts, "close")
    # One more row than the frame: the first return of the frame needs the close before it.
    blocks = block_table(src, n, key, ts, block_rows)
    r = _returns(blocked(src, blocks, key, ts), key, ts)
    if drop_first:
        # Null returns leave before the frame, so positions change: with blocks,
        # the frame gets a table of its own (a subset of few enough rows needs none).
        kept = r.where("_own").where(F.col("logret").isNotNull()).select(key, ts, "logret")
        r = blocked(kept, block_table(kept, n - 1, key, ts, block_rows) if blocks else None, key, ts)
    return _rolled(r, n, False, key, ts)


def first_last(bars: DataFrame, key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """FIRST_VALUE(open), LAST_VALUE(close), SUM(volume) over each
    instrument's whole frame, as one grouped aggregate (W1-W3, A11).

    Equivalent to the unbounded window plus DISTINCT, but with partial
    aggregation: one row per instrument and task leaves the map side.
    """
    return bars.groupBy(key).agg(
        F.min_by("open", F.col(ts)).alias("first_open"),
        F.max_by("close", F.col(ts)).alias("last_close"),
        F.sum("volume").alias("vol_sum"))


def first_last_window(bars: DataFrame, key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """The reference's form of W1-W3 and A11: FIRST_VALUE / LAST_VALUE / SUM
    over one named unbounded window per instrument, then DISTINCT.

    Kept to compare with ``first_last`` (same rows); it sorts each
    instrument's rows in one task, so ``first_last`` is the one to use.
    """
    w = (Window.partitionBy(key).orderBy(ts)
         .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return bars.select(key, F.first("open").over(w).alias("first_open"),
                       F.last("close").over(w).alias("last_close"),
                       F.sum("volume").over(w).alias("vol_sum")).distinct()
