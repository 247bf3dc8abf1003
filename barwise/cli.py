"""Command line for the reference's workflow, run as Spark jobs.

    python -m barwise seed --constituents c.csv --lake lake/
    python -m barwise pages --input landed/ --out data/
    python -m barwise load --input data/ [--glob 'bars_*.parquet'] --lake lake/ [--append | --months]
    python -m barwise market-data --input data/ --constituents c.csv --lake lake/
    python -m barwise calendar --lake lake/
    python -m barwise rollup --lake lake/ [--months 2024-11 2024-12]
    python -m barwise validate --lake lake/
    python -m barwise scenario chart --symbol AAPL --start 2024-03-01 --end 2024-04-01 --lake lake/

A lake folder holds ``ticker``, ``sector``, ``industry`` (dimensions),
``bar_5m`` (month-partitioned bars) and ``bar_1d`` (the stored rollup), both
versioned: a step that fails leaves the version before. A load replaces all
bars unless told to append or to replace only the months it brings, and stops
at rows that break the bar rules unless told otherwise.
Without ``--master`` the session comes from the environment
(``spark-submit`` or defaults).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from barwise.operators import quality as qc
from barwise.operators import refdata as rd
from barwise.operators.filters import regular_hours
from barwise.plans import chart, cross_section, market, movers, rollup, volatility
from barwise.session import checkpoint_root
from barwise.sinks import layout
from barwise.sinks.market_data import load_market_data, read_or_none
from barwise.sinks.tables import VersionedTable, read_table_at
from barwise.sources import normalise_pages, read_bars, read_constituents
from barwise.sources.seed import exchanges

SCENARIOS = ("chart", "daily", "daily_raw", "cross_section", "movers", "volatility", "market")


def _session(args) -> SparkSession:
    b = SparkSession.builder.appName("barwise")
    if args.master:
        b = b.master(args.master)
    return b.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _read(spark, lake: str, name: str):
    return read_table_at(spark, f"{lake.rstrip('/')}/{name}")


def _versioned(spark, lake: str, name: str) -> VersionedTable:
    return VersionedTable(spark, f"{lake.rstrip('/')}/{name}")


def cmd_seed(spark, args) -> dict:
    """Seed sectors, industries and tickers from the constituents CSV,
    keeping ids of rows already in the lake (re-seeding upserts)."""
    const = read_constituents(spark, args.constituents, numbered=True)
    lake = args.lake.rstrip("/")
    found = {n: read_or_none(spark, f"{lake}/{n}") for n in ("sector", "industry", "ticker")}
    # First seed when none exists; any other read error propagates.
    old = found if all(v is not None for v in found.values()) else None
    if old is None and any(v is not None for v in found.values()):
        raise ValueError(f"{lake}: some reference tables exist and some do not")
    sectors = rd.build_sectors(const, old["sector"] if old else None)
    industries = rd.build_industries(const, sectors, old["industry"] if old else None)
    ex = exchanges(spark)
    tickers = (rd.refresh_tickers(old["ticker"], const, sectors, industries, ex) if old
               else rd.build_tickers(const, sectors, industries, ex))
    # The new tables are derived from the old ones: cut their lineage with an
    # eager checkpoint (the session's checkpoint dir) before the old folders
    # are overwritten, so no job reads and replaces the same files.
    checkpoint_root(spark)
    out = {}
    frames = {"sector": sectors, "industry": industries, "ticker": tickers, "exchange": ex}
    frames = {n: df.checkpoint(eager=True) for n, df in frames.items()}
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{lake}/{name}")
        out[name] = spark.read.parquet(f"{lake}/{name}").count()
    return out


def cmd_pages(spark, args) -> dict:
    """Landed vendor pages (one JSON document a file) to one bar file folder per year."""
    pages = spark.read.option("wholetext", True).text(args.input).withColumnRenamed("value", "page")
    layout.write_yearly(normalise_pages(pages), args.out)
    return {"rows": read_bars(spark, args.out, glob="*.parquet").count()}


def cmd_load(spark, args) -> dict:
    """load_bars: vendor files to the month-partitioned bar table."""
    bars = read_bars(spark, args.input, glob=args.glob)
    tickers = _read(spark, args.lake, "ticker")
    report: dict = {}
    layout.load_bars(bars, tickers, _versioned(spark, args.lake, "bar_5m"), args.start, args.end,
                     mode="append" if args.append else "overwrite" if args.months else "truncate", report=report,
                     on_duplicate="first" if args.keep_first else "fail", on_bad=args.on_bad)
    return report


def cmd_market_data(spark, args) -> dict:
    """The second loader: bars with symbol, name and sector tables of their own."""
    const = read_constituents(spark, args.constituents)
    meta = const.select(F.trim("Symbol").alias("symbol"), F.trim("Security").alias("name"), F.trim("GICS Sector").alias("sector"))
    lake = args.lake.rstrip("/")
    return load_market_data(read_bars(spark, args.input, glob=args.glob), meta, f"{lake}/market_data", f"{lake}/symbols", args.start, args.end)


def cmd_calendar(spark, args) -> dict:
    """Sessions of the loaded bars' regular hours, upserted into the trading calendar."""
    path = f"{args.lake.rstrip('/')}/trading_calendar"
    sessions = rd.sessions_from_bars(regular_hours(_read(spark, args.lake, "bar_5m")))
    table = rd.refresh_calendar(read_or_none(spark, path), sessions, _read(spark, args.lake, "exchange"))
    checkpoint_root(spark)
    table.checkpoint(eager=True).write.mode("overwrite").parquet(path)
    return {"rows": spark.read.parquet(path).count()}


def cmd_rollup(spark, args) -> dict:
    """Build the daily rollup bar_1d, or refresh only some months."""
    bars = _read(spark, args.lake, "bar_5m")
    table = _versioned(spark, args.lake, "bar_1d")
    if args.months:
        rollup.refresh_daily(bars, table, args.months)
    else:
        rollup.build_daily(bars, table)
    return {"rows": table.read().count(), "version": table.version()}


def cmd_validate(spark, args) -> dict:
    """Validate the loaded bars: totals, rule violations, duplicates, unknown refs."""
    bars = _read(spark, args.lake, "bar_5m")
    row = qc.validate_load(bars, _read(spark, args.lake, "ticker")).first().asDict()
    return {k: str(v) for k, v in row.items()}


def cmd_scenario(spark, args) -> dict:
    """The scenario queries with their parameters; prints the rows."""
    bars = _read(spark, args.lake, "bar_5m")
    dims = _read(spark, args.lake, "ticker")
    name = args.name
    if name == "chart":
        df = chart.ticker_chart(bars, dims, args.symbol, args.start, args.end)
    elif name == "daily":
        df = chart.daily_chart(_read(spark, args.lake, "bar_1d"), dims, args.symbol,
                               args.start, args.end)
    elif name == "daily_raw":
        df = rollup.daily_rollup_for(bars, dims, args.symbol, args.start, args.end)
    elif name == "cross_section":
        df = cross_section.cross_section(bars, dims, args.at)
    elif name == "movers":
        df = movers.top_movers(bars, dims, args.start, args.end, args.n, with_volume=True)
    elif name == "volatility":
        df = volatility.volatility_scan(bars, dims, args.window, drop_first=True,
                                        t0=args.start, t1=args.end, symbol=args.symbol)
    else:
        df = market.market_volume(bars, args.start, args.end)
    n = 0
    # Row by row: the driver holds one partition of the result at a time.
    for r in (df.limit(args.show) if args.show else df).toLocalIterator():
        print(json.dumps(r.asDict(), default=str))
        n += 1
    return {"rows": n}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="barwise", description=__doc__.split("\n")[0])
    p.add_argument("--master", default=None, help="Spark master; default from the environment")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("seed")
    s.add_argument("--constituents", required=True)
    s.add_argument("--lake", required=True)
    s = sub.add_parser("load")
    s.add_argument("--input", nargs="+", required=True)
    s.add_argument("--glob", default=None)
    s.add_argument("--lake", required=True)
    s.add_argument("--start", default="2023-01-01")
    s.add_argument("--end", default="2025-01-01")
    how = s.add_mutually_exclusive_group()
    how.add_argument("--append", action="store_true", help="keep existing bars (no truncate)")
    how.add_argument("--months", action="store_true", help="replace only the months in the input")
    s.add_argument("--on-bad", choices=("fail", "drop", "keep"), default="fail",
                   help="rows that break the bar rules")
    s.add_argument("--keep-first", action="store_true",
                   help="keep the first row of a duplicated key instead of failing")
    s = sub.add_parser("pages")
    s.add_argument("--input", nargs="+", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("market-data")
    s.add_argument("--input", nargs="+", required=True)
    s.add_argument("--glob", default=None)
    s.add_argument("--constituents", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--start", default="2023-01-01")
    s.add_argument("--end", default="2025-01-01")
    s = sub.add_parser("calendar")
    s.add_argument("--lake", required=True)
    s = sub.add_parser("rollup")
    s.add_argument("--lake", required=True)
    s.add_argument("--months", nargs="*", default=None)
    s = sub.add_parser("validate")
    s.add_argument("--lake", required=True)
    s = sub.add_parser("scenario")
    s.add_argument("name", choices=SCENARIOS)
    s.add_argument("--lake", required=True)
    s.add_argument("--symbol", default=None)
    s.add_argument("--start", default=None)
    s.add_argument("--end", default=None)
    s.add_argument("--at", default=None, help="bar time for cross_section")
    s.add_argument("--n", type=int, default=20)
    s.add_argument("--window", type=int, default=20)
    s.add_argument("--show", type=int, default=0, help="print at most this many rows")
    return p


COMMANDS = {"seed": cmd_seed, "pages": cmd_pages, "load": cmd_load, "market-data": cmd_market_data,
            "calendar": cmd_calendar, "rollup": cmd_rollup,
            "validate": cmd_validate, "scenario": cmd_scenario}


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = spark or _session(args)
    result = COMMANDS[args.cmd](spark, args)
    print(json.dumps({"cmd": args.cmd, **result}, default=str), file=sys.stderr)
    return result


if __name__ == "__main__":
    main()
