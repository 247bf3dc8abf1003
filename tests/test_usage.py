"""The README workflow end to end: seed reference data from a constituents
CSV, load vendor bar files, validate, build the rollup, run each scenario."""

import os

from barwise import fixtures as fx
from barwise.operators import quality as qc
from barwise.operators import refdata as rd
from barwise.plans import chart, cross_section, market, movers, rollup, volatility
from barwise.session import scratch_path
from barwise.sinks import layout
from barwise.sources import read_bars, read_constituents
from barwise.sources.seed import exchanges

SF = "/root/testdata/sf0.001"


def test_reference_workflow(spark):
    root = scratch_path(spark, "usage")
    # constituents.csv from nations (symbols) and regions (sectors)
    nations = fx.instruments_a(spark, SF).collect()
    os.makedirs(root + "/csv")
    with open(root + "/csv/constituents.csv", "w") as f:
        f.write("Symbol,Security,GICS Sector,GICS Sub-Industry,Headquarters Location,"
                "Date added,CIK,Founded\n")
        for n in nations:
            f.write(f"{n.symbol},{n.name} Inc,{n.sector},{n.sector} sub,,2000-01-01,{n.ticker_id},\n")
    const = read_constituents(spark, root + "/csv")
    sectors = rd.build_sectors(const)
    industries = rd.build_industries(const, sectors)
    tickers = rd.build_tickers(const, sectors, industries, exchanges(spark))
    assert tickers.count() == len(nations)

    layout.write_yearly(fx.vendor_rows_a(spark, SF), root + "/data")
    vendor = read_bars(spark, [root + "/data"], glob="*.parquet")
    report = {}
    layout.load_bars(vendor, tickers, root + "/bar_5m", "2023-01-01", "2025-01-01",
                     report=report)
    assert report["loaded"] == report["attempted"] == vendor.count()
    bars = spark.read.parquet(root + "/bar_5m")
    v = qc.validate_load(bars, tickers).first()
    assert v.rows == vendor.count() and v.duplicated_keys == 0 and v.unknown_refs == 0
    rollup.build_daily(bars, root + "/bar_1d")
    daily = spark.read.parquet(root + "/bar_1d")
    from barwise.operators.aggregates import most_active
    sym = most_active(bars, tickers, 1).first().symbol

    assert chart.ticker_chart(bars, tickers, sym, "2024-01-01", "2024-02-01").count() > 0
    cross_section.cross_section(bars, tickers, "2024-01-16 19:55:00").collect()
    assert movers.top_movers(bars, tickers, "2024-01-15 00:00:00", "2024-01-17 00:00:00").count() > 0
    volatility.volatility_scan(bars, tickers, 20, symbol=sym,
                               t0="2024-01-02 00:00:00", t1="2024-01-30 00:00:00").collect()
    a = rollup.daily_rollup_for(bars, tickers, sym, "2024-01-01", "2025-01-01").collect()
    b = chart.daily_chart(daily, tickers, sym, "2024-01-01", "2025-01-01").collect()
    assert [tuple(x)[:6] for x in a] == [tuple(x)[:6] for x in b] and len(a) > 0
    assert market.market_volume(bars, "2024-01-02 14:30:00", "2024-01-06 00:00:00").count() > 0
    n = daily.count()
    rollup.refresh_daily(bars, root + "/bar_1d", ["2024-01"])
    # Re-read after a refresh: the old DataFrame lists replaced files.
    assert spark.read.parquet(root + "/bar_1d").count() == n
