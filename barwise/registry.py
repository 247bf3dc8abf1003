"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (through ``barwise.fixtures``) and
for each name is in ``barwise.registry_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.functions.numeric import round6, round_dec
from barwise.functions.timefn import month_key
from barwise.operators import aggregates as agg
from barwise.operators import quality as qc
from barwise.operators import refdata as rd
from barwise.operators.filters import loaded_bounds
from barwise.operators.joins import (bounded_broadcast, enrich_symbols, resolve_ids,
                                     symbols_without_bars)
from barwise.plans import chart as ch
from barwise.plans import cross_section as cs
from barwise.plans import market as mk
from barwise.plans import movers as mv
from barwise.plans import rollup as ru
from barwise.plans.volatility import volatility_scan
from barwise.session import scratch_path
from barwise.sinks import layout as lay
from barwise.sinks import merge as mg
from barwise.sinks.tables import staged
from barwise.sources.files import profile_input, read_bars, read_table
from barwise.sources.seed import exchanges
from barwise.sources.vendor import normalise_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


SYM_A = "NATION_7"
SNAP_B = "1998-06-15 00:00:00"
MOVERS_T0, MOVERS_T1 = "2024-01-15 14:30:00", "2024-01-15 20:30:00"


def _a(spark, sf):
    return fx.bars_a(spark, sf), fx.instruments_a(spark, sf)


def _b(spark, sf):
    return fx.bars_b(spark, sf), fx.instruments_b(spark, sf)


@query("bars_from_ticks")
def q_bars_from_ticks(spark, sf):
    return fx.bars_a(spark, sf)


@query("ticker_chart")
def q_ticker_chart(spark, sf):
    t0, t1 = "2024-01-08 00:00:00", "2024-01-15 00:00:00"
    return ch.ticker_chart(fx.bars_a(spark, sf, t0, t1), fx.instruments_a(spark, sf), SYM_A, t0, t1)


@query("chart_regular_hours")
def q_chart_regular_hours(spark, sf):
    t0, t1 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    return ch.chart_local(fx.bars_a(spark, sf, t0, t1), fx.instruments_a(spark, sf), SYM_A, t0, t1)


@query("chart_daily_weekdays")
def q_chart_daily_weekdays(spark, sf):
    bars, dims = _a(spark, sf)
    daily = ru.daily_rollup(bars)
    grain, df = ch.chart(bars, daily, dims, SYM_A, "2024-01-01", "2024-02-01")
    assert grain == "daily"
    return df.withColumn("vwap", round6("vwap"))


@query("cross_section")
def q_cross_section(spark, sf):
    bars, dims = _b(spark, sf)
    return cs.cross_section(bars, dims, SNAP_B)


@query("cross_section_sector")
def q_cross_section_sector(spark, sf):
    bars, dims = _b(spark, sf)
    return cs.cross_section_sector(bars, dims, SNAP_B)


@query("top_movers")
def q_top_movers(spark, sf):
    bars, dims = fx.bars_a(spark, sf, MOVERS_T0, MOVERS_T1), fx.instruments_a(spark, sf)
    return mv.top_movers(bars, dims, MOVERS_T0, MOVERS_T1, 20)


@query("top_movers_volume")
def q_top_movers_volume(spark, sf):
    bars, dims = fx.bars_a(spark, sf, MOVERS_T0, MOVERS_T1), fx.instruments_a(spark, sf)
    return mv.top_movers(bars, dims, MOVERS_T0, MOVERS_T1, 20, with_volume=True)


@query("top_movers_local")
def q_top_movers_local(spark, sf):
    bars, dims = _a(spark, sf)
    return mv.top_movers_local(bars, dims, "2024-01-15", "09:30", "15:30", 20)


@query("chart_raw_grain")
def q_chart_raw_grain(spark, sf):
    """A range of five days or less stays at bar grain."""
    bars, dims = _a(spark, sf)
    grain, df = ch.chart(bars, ru.daily_rollup(bars), dims, SYM_A, "2024-01-08", "2024-01-11")
    assert grain == "raw"
    return df


@query("multi_symbol_chart")
def q_multi_symbol_chart(spark, sf):
    """Bars of several instruments by symbol list."""
    from barwise.operators.filters import for_symbol, time_range
    bars, dims = _a(spark, sf)
    b = for_symbol(time_range(bars, "2024-01-08 00:00:00", "2024-01-22 00:00:00"), dims,
                   ["NATION_1", "NATION_7", "NATION_13"])
    return b.select("symbol", "ts", "open", "close", "volume")


@query("cross_section_one_sector")
def q_cross_section_one_sector(spark, sf):
    """P10: the app's snapshot filtered to one sector."""
    bars, dims = _b(spark, sf)
    return cs.cross_section_sector(bars, dims, SNAP_B, sector="ASIA")


@query("session_clock")
def q_session_clock(spark, sf):
    """local date and time of each session's first and last bar
    in New York, with the early-close flag."""
    from barwise.functions.timefn import is_early_close, local_date, local_time
    bars = fx.bars_a(spark, sf)
    per_day = bars.groupBy(local_date("ts").alias("session_date")).agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return per_day.select("session_date", local_time("first_ts").alias("first_local"),
                          local_time("last_ts").alias("last_local"),
                          is_early_close(F.col("last_ts")).alias("closes_before_1930_utc"))


@query("vendor_pages_null_vwap")
def q_vendor_pages_null_vwap(spark, sf):
    """S7 with missing vwap kept null instead of the reference's 0.0."""
    return normalise_pages(fx.pages_c(spark, sf), missing_vwap=None)


@query("rolling_vol_hot_instrument")
def q_rolling_vol_hot_instrument(spark, sf):
    """Q6 where one instrument holds about two fifths of the rows; small
    blocks make the hot instrument span many blocks with halos, so the
    blocked window is checked against the plain window of the oracle."""
    from barwise.operators.windows import rolling_vol
    bars = fx.bars_b(spark, sf, hot=True)
    return rolling_vol(bars, 20, block_rows=500).select(
        "ticker_id", "ts", round6("rv").alias("rv"))


@query("rolling_vol_hot_drop_first")
def q_rolling_vol_hot_drop_first(spark, sf):
    """Q6b over the same hot instrument in blocks of 500 rows."""
    from barwise.operators.windows import rolling_vol
    bars = fx.bars_b(spark, sf, hot=True)
    return rolling_vol(bars, 10, drop_first=True, block_rows=500).select(
        "ticker_id", "ts", round6("rv").alias("rv"))


@query("rolling_vol")
def q_rolling_vol(spark, sf):
    bars, dims = _b(spark, sf)
    return volatility_scan(bars, dims, 20).withColumn("rv", round6("rv"))


@query("rolling_vol_window")
def q_rolling_vol_window(spark, sf):
    bars, dims = _b(spark, sf)
    return volatility_scan(bars, dims, 10, drop_first=True).withColumn("rv", round6("rv"))


@query("daily_rollup")
def q_daily_rollup(spark, sf):
    t0, t1 = "2024-01-01 00:00:00", "2025-01-01 00:00:00"
    return ru.daily_rollup_for(fx.bars_a(spark, sf, t0, t1), fx.instruments_a(spark, sf), SYM_A, t0, t1)


@query("daily_rollup_all")
def q_daily_rollup_all(spark, sf):
    bars, _ = _a(spark, sf)
    return ru.daily_rollup(bars).withColumn("vwap", round6("vwap"))


def _stored_daily_a(spark, sf) -> DataFrame:
    """Fixture A's rollup written as a table (M1) and read back."""
    path = scratch_path(spark, "bar_1d")
    ru.build_daily(fx.bars_a(spark, sf), path)
    return ru.read_rollup(spark, path)


@query("daily_from_rollup")
def q_daily_from_rollup(spark, sf):
    daily = _stored_daily_a(spark, sf)
    dims = fx.instruments_a(spark, sf)
    return (ch.daily_chart(daily, dims, SYM_A, "2024-01-01", "2025-01-01")
            .withColumn("vwap", round6("vwap")))


@query("rollup_refresh_month")
def q_rollup_refresh_month(spark, sf):
    bars = fx.bars_b(spark, sf)
    path = scratch_path(spark, "bar_1m")
    kw = dict(period="month", tz="UTC", session=None)
    ru.build_daily(bars.where(F.date_format("ts", "yyyy-MM") != "1998-06"), path, **kw)
    ru.refresh_daily(bars, path, ["1998-06"], **kw)
    return (ru.read_rollup(spark, path).select(*ru.DAILY_COLS)
            # Off the exact half-way cases, which sums in another order may miss.
            .withColumn("vwap", round6(F.col("vwap") + F.lit(1e-8))))


@query("rollup_key_violations")
def q_rollup_key_violations(spark, sf):
    return qc.key_report(_stored_daily_a(spark, sf), ["ticker_id", "session_date"])


@query("rollup_matches_raw")
def q_rollup_matches_raw(spark, sf):
    stored = _stored_daily_a(spark, sf).select(*ru.DAILY_COLS).withColumn("vwap", round6("vwap"))
    raw = ru.daily_rollup(fx.bars_a(spark, sf)).withColumn("vwap", round6("vwap"))
    return ru.compare(raw, stored, by=month_key("session_date"))


@query("rollup_differs_from_raw")
def q_rollup_differs_from_raw(spark, sf):
    """M5 with one stored volume changed: the comparison must show it."""
    hit = (F.col("ticker_id") == 7) & (F.col("session_date") == F.lit("2024-01-10").cast("date"))
    stored = (_stored_daily_a(spark, sf).select("ticker_id", "session_date", "volume")
              .withColumn("volume", F.when(hit, F.col("volume") + 1).otherwise(F.col("volume"))))
    raw = ru.daily_rollup(fx.bars_a(spark, sf)).select("ticker_id", "session_date", "volume")
    return ru.compare(raw, stored, by=month_key("session_date"))


@query("bars_subcent_ticks")
def q_bars_subcent_ticks(spark, sf):
    """A14 over prices with fractions of a cent."""
    from barwise.operators.bars import ohlcv_from_ticks
    ticks = fx.ticks_b(spark, sf).withColumn("size", F.col("l_quantity").cast("bigint"))
    aggs = ohlcv_from_ticks("price", "size", fx.TICK_ORDER_B, ticks.schema)
    return (ticks.groupBy("ticker_id", "ts").agg(*aggs)
            .select("ticker_id", "ts", "high", "low", "volume",
                    round_dec(F.col("vwap") * F.col("volume"), 2).alias("dollars"), "trade_count"))


@query("daily_huge_dollars")
def q_daily_huge_dollars(spark, sf):
    """A7 over bars worth more than 10^12 dollars each."""
    big = fx.bars_a(spark, sf).withColumn("volume", F.col("volume") * 1000000).withColumn("vwap", F.col("vwap") * 100000)
    d = ru.rollup(big, "day", "UTC", None)
    return d.select("ticker_id", "session_date", "volume", round_dec("vwap", 3).alias("vwap"))


@query("stream_refresh")
def q_stream_refresh(spark, sf):
    """M2/M3 driven by landed files: fixture A's bars land in two
    overlapping batches; the stream loads them (insert-ignore) and refreshes
    the touched rollup months. Result: the stored daily rollup."""
    from barwise.streaming import start_refresh
    bars = fx.bars_a(spark, sf)
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    fact, daily = scratch_path(spark, "fact"), scratch_path(spark, "bar_1d")
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    bars.where(F.col("ts") < cut).write.parquet(landing + "/batch=1")
    start_refresh(spark, landing, fact, daily, "2023-01-01", "2025-01-01", ckpt).awaitTermination()
    bars.where(F.col("ts") >= cut - F.expr("INTERVAL 2 DAYS")).write.parquet(landing + "/batch=2")
    start_refresh(spark, landing, fact, daily, "2023-01-01", "2025-01-01", ckpt).awaitTermination()
    return (spark.read.parquet(daily).select(*ru.DAILY_COLS)
            .withColumn("vwap", round6("vwap")))


@query("cross_section_day_layout")
def q_cross_section_day_layout(spark, sf):
    """Q2 over fixture A loaded with the optional day sub-partition: the
    read prunes to the two day folders it needs."""
    path = scratch_path(spark, "bar_5m_by_day")
    dims = fx.instruments_a(spark, sf)
    lay.load_bars(fx.vendor_rows_a(spark, sf), dims, path, "2023-01-01", "2025-01-01",
                  by_day=True)
    return cs.cross_section(spark.read.parquet(path), dims, "2024-01-22 04:00:00")


@query("cross_section_curve_layout")
def q_cross_section_curve_layout(spark, sf):
    """Q2 over fixture A clustered by instrument and time alike (Z-order)."""
    path = scratch_path(spark, "bar_5m_curve")
    dims = fx.instruments_a(spark, sf)
    lay.load_bars(fx.vendor_rows_a(spark, sf), dims, path, "2023-01-01", "2025-01-01", curve=True)
    return cs.cross_section(spark.read.parquet(path), dims, "2024-01-22 04:00:00")


@query("ticker_chart_curve_layout")
def q_ticker_chart_curve_layout(spark, sf):
    """Q1 over the same layout."""
    path = scratch_path(spark, "bar_5m_curve")
    dims = fx.instruments_a(spark, sf)
    lay.load_bars(fx.vendor_rows_a(spark, sf), dims, path, "2023-01-01", "2025-01-01", curve=True)
    return ch.ticker_chart(spark.read.parquet(path), dims, SYM_A, "2024-01-08 00:00:00", "2024-01-15 00:00:00")


@query("market_volume")
def q_market_volume(spark, sf):
    t0, t1 = "2024-01-02 14:30:00", "2024-01-06 00:00:00"
    return (mk.market_volume(fx.bars_a(spark, sf, t0, t1), t0, t1)
            .withColumn("dollar_volume", round_dec("dollar_volume", 2)))


@query("list_symbols")
def q_list_symbols(spark, sf):
    return rd.list_symbols(fx.ticker_b(spark, sf), fx.industry_b(spark, sf),
                           fx.sector_b(spark, sf))


@query("date_bounds")
def q_date_bounds(spark, sf):
    b = agg.date_bounds(fx.bars_a(spark, sf))
    lo, hi = loaded_bounds(F.to_date("mn"), F.to_date("mx"),
                           F.lit("2024-01-05").cast("date"), F.lit("2024-01-25").cast("date"))
    return b.select("mn", "mx", lo.alias("from_date"), hi.alias("to_date"))


@query("load_summary")
def q_load_summary(spark, sf):
    return agg.load_summary(fx.bars_a(spark, sf))


@query("most_active")
def q_most_active(spark, sf):
    bars, dims = _a(spark, sf)
    return agg.most_active(bars, dims, 5)


@query("symbols_without_bars")
def q_symbols_without_bars(spark, sf):
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_name"])
    ev = read_table(spark, sf, "events", ["user_id"]).withColumnRenamed("user_id", "c_custkey")
    return symbols_without_bars(cust, ev, "c_custkey")


@query("session_sample")
def q_session_sample(spark, sf):
    t0, t1 = "2024-01-03 14:30:00", "2024-01-03 21:00:00"
    return ch.session_sample(fx.bars_a(spark, sf, t0, t1), fx.instruments_a(spark, sf), SYM_A, t0, t1, 10)


def _routed_b(spark, sf, start, end) -> DataFrame:
    return lay.assign_month(fx.bars_b(spark, sf), start, end)


@query("partition_stats")
def q_partition_stats(spark, sf):
    return agg.partition_stats(_routed_b(spark, sf, "1995-01-01", "2002-01-01"))


def _ship_span(spark, sf) -> DataFrame:
    li = read_table(spark, sf, "lineitem", ["l_shipdate"])
    return li.agg(F.to_date(F.min("l_shipdate")).alias("lo"),
                  F.date_add(F.to_date(F.max("l_shipdate")), 1).alias("hi"))


@query("month_bounds")
def q_month_bounds(spark, sf):
    return lay.month_table(_ship_span(spark, sf), F.col("lo"), F.col("hi"))


@query("year_windows")
def q_year_windows(spark, sf):
    w = _ship_span(spark, sf).select(F.explode(lay.year_windows(F.col("lo"), F.col("hi")))
                                     .alias("w"))
    return w.select("w.window_start", "w.window_end")


@query("month_routing")
def q_month_routing(spark, sf):
    routed = _routed_b(spark, sf, "1996-01-01", "2001-01-01")
    return routed.groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


def _vendor_rows_b(spark, sf) -> DataFrame:
    bars = fx.bars_b(spark, sf)
    syms = bounded_broadcast(fx.ticker_b(spark, sf).select("ticker_id", "symbol"))
    return bars.join(syms, "ticker_id").select(
        "symbol", F.col("ts").alias("timestamp"), "open", "high", "low", "close", "volume",
        "vwap", "trade_count")


@query("load_partitioned")
def q_load_partitioned(spark, sf):
    path = scratch_path(spark, "bar_ship")
    return lay.load_bars(_vendor_rows_b(spark, sf), fx.ticker_b(spark, sf), path,
                         "1995-01-01", "2002-01-01")


@query("validate_load")
def q_validate_load(spark, sf):
    """Load fixture B's bars (K2) and validate the stored table."""
    path = scratch_path(spark, "bar_ship")
    lay.load_bars(_vendor_rows_b(spark, sf), fx.ticker_b(spark, sf), path,
                  "1995-01-01", "2002-01-01")
    stored = spark.read.parquet(path)
    return qc.validate_load(stored, fx.ticker_b(spark, sf))


@query("market_data_load")
def q_market_data_load(spark, sf):
    """The second loader (K7, K8, K10, P12, J10, T22, T23): fixture B's bars
    with names and sectors known for suppliers of one region only, into
    market_data over 1996-2000, loaded twice (the second load inserts
    nothing). Rows per sector of the loaded table."""
    from barwise.sinks.market_data import load_market_data
    # Derived once for both loads, with the columns that the loader reads.
    vendor = staged(_vendor_rows_b(spark, sf).drop("vwap", "trade_count"), scratch_path(spark, "vendor"))
    meta = (_supplier_const(spark, sf).where(F.col("r_name") == "AMERICA")
            .select(F.col("Symbol").alias("symbol"), F.concat("Security", F.lit(" Corp"))
                    .alias("name"), F.col("GICS Sector").alias("sector")))
    path, syms = scratch_path(spark, "market_data"), scratch_path(spark, "symbols")
    first = load_market_data(vendor, meta, path, syms, "1996-01-01", "2001-01-01")
    again = load_market_data(vendor, meta, path, syms, "1996-01-01", "2001-01-01")
    assert again["inserted"] == 0 and again["attempted"] == first["attempted"]
    md = spark.read.parquet(path)
    s = spark.read.parquet(syms)
    return (md.join(s, "symbol_id").groupBy("sector").agg(
        F.countDistinct("symbol_id").alias("symbols"), F.count(F.lit(1)).alias("bars"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.sum("close").cast("double").alias("sum_close")))


@query("yearly_export")
def q_yearly_export(spark, sf):
    path = scratch_path(spark, "yearly")
    lay.write_yearly(_vendor_rows_b(spark, sf), path)
    back = read_bars(spark, [path], glob="*.parquet")
    return back.groupBy(F.year("timestamp").alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


@query("insert_ignore")
def q_insert_ignore(spark, sf):
    b1, b2 = fx.batches_d(spark, sf)
    return mg.insert_ignore(b1, mg.sort_for_insert(b2, ["o_orderdate", "o_orderkey"]),
                            ["o_orderkey"])


@query("upsert")
def q_upsert(spark, sf):
    b1, b2 = fx.batches_d(spark, sf)
    return mg.upsert(b1, b2, ["o_orderkey"]).select(*fx.ORDER_COLS)


def _check_rows(spark, sf) -> DataFrame:
    li = read_table(spark, sf, "lineitem", ["l_extendedprice", "l_quantity", "l_linenumber"])
    p = F.try_divide("l_extendedprice", "l_quantity")
    n = F.col("l_linenumber")
    q = F.col("l_quantity").cast("bigint")
    return li.select(p.alias("open"), p.alias("close"),
                     F.when(n == 1, p - 1).otherwise(p).alias("high"),
                     F.when(n == 2, p + 1).otherwise(p).alias("low"),
                     F.when(n == 3, -q).otherwise(q).alias("volume"))


@query("check_bars")
def q_check_bars(spark, sf):
    """Rows breaking each rule, quarantined rows and total in one pass."""
    rules = qc.bar_rules(nonneg_prices=True)
    rows = _check_rows(spark, sf)
    return rows.select(
        *[F.count_if(~F.coalesce(c, F.lit(True))).alias(nm) for nm, c in rules],
        F.count_if(F.size(qc.violations(rules)) > 0).alias("quarantined"),
        F.count(F.lit(1)).alias("total"))


@query("key_duplicates")
def q_key_duplicates(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber"])
    return qc.duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def _ev_symbols(spark, sf) -> tuple[DataFrame, DataFrame]:
    ev = read_table(spark, sf, "events", ["event_id", "user_id"])
    cust = read_table(spark, sf, "customer", ["c_custkey", "c_name", "c_nationkey",
                                              "c_mktsegment"])
    names = cust.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("symbol"))
    ev = ev.join(bounded_broadcast(names), "user_id").select("event_id", "symbol")
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"]).where("r_name = 'AMERICA'")
    america = n.join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey).select("n_nationkey")
    dims = (cust.join(bounded_broadcast(america), cust.c_nationkey == america.n_nationkey)
            .select(F.col("c_custkey").alias("ticker_id"), F.col("c_name").alias("symbol"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sector")))
    return ev, dims


@query("resolve_ids")
def q_resolve_ids(spark, sf):
    ev, dims = _ev_symbols(spark, sf)
    resolved, _ = resolve_ids(ev, dims, on_unknown="add")
    return resolved.agg(F.count("ticker_id").alias("kept"),
                        F.count_if(F.col("ticker_id").isNull()).alias("dropped"))


@query("enrich_symbols")
def q_enrich_symbols(spark, sf):
    ev, dims = _ev_symbols(spark, sf)
    return enrich_symbols(ev.select("symbol").distinct(), dims)


def _part_const(spark, sf) -> DataFrame:
    p = read_table(spark, sf, "part", ["p_brand", "p_type"])
    return p.select(F.col("p_brand").alias("GICS Sector"),
                    F.col("p_type").alias("GICS Sub-Industry"))


@query("sector_industry")
def q_sector_industry(spark, sf):
    const = _part_const(spark, sf)
    sectors = rd.build_sectors(const)
    inds = rd.build_industries(const, sectors)
    s = sectors.select("sector_id", F.col("name").alias("sector"))
    return (inds.join(s, "sector_id")
            .select("industry_id", "sector_id", "sector", F.col("name").alias("industry")))


def _supplier_const(spark, sf) -> DataFrame:
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    n = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    geo = bounded_broadcast(n.join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey))
    j = s.join(geo, s.s_nationkey == geo.n_nationkey)
    return j.select(
        F.col("s_name").alias("Symbol"), F.col("s_name").alias("Security"),
        F.col("r_name").alias("GICS Sector"), F.col("n_name").alias("GICS Sub-Industry"),
        F.when(F.col("s_acctbal") < 0, F.lit("n/a"))
        .otherwise(F.col("s_suppkey").cast("string")).alias("CIK"),
        F.when(F.col("s_acctbal") < 1000, F.lit(""))
        .otherwise(F.col("n_name")).alias("Headquarters Location"),
        F.lit("").alias("Date added"), F.col("s_suppkey"), F.col("r_name"))


@query("build_tickers")
def q_build_tickers(spark, sf):
    const = _supplier_const(spark, sf)
    sectors = rd.build_sectors(const)
    inds = rd.build_industries(const, sectors)
    t = rd.build_tickers(const, sectors, inds, exchanges(spark))
    ind = inds.select("industry_id", "sector_id")
    return t.join(ind, "industry_id").select(
        "ticker_id", "symbol", "exchange_id", "sector_id", "industry_id", "cik", "headquarters")


def _america_names(spark, sf) -> DataFrame:
    c = _supplier_const(spark, sf)
    return c.where(F.col("r_name") == "AMERICA").select(F.col("Symbol").alias("symbol"))


@query("tag_exchange")
def q_tag_exchange(spark, sf):
    s = read_table(spark, sf, "supplier", ["s_name"]).select(F.col("s_name").alias("symbol"))
    return rd.tag_exchange(s, _america_names(spark, sf))


def _variant_const(spark, sf) -> tuple[DataFrame, DataFrame]:
    c = _supplier_const(spark, sf)
    dots = c.select((F.col("s_suppkey") * 2).alias("row_no"),
                    F.replace("Symbol", F.lit("#"), F.lit(".")).alias("Symbol"),
                    "Security", "GICS Sector")
    dashes = c.where(F.col("r_name") == "ASIA").select(
        (F.col("s_suppkey") * 2 + 1).alias("row_no"),
        F.lower(F.replace("Symbol", F.lit("#"), F.lit("-"))).alias("Symbol"),
        F.concat("Security", F.lit(" B")).alias("Security"), "GICS Sector")
    s = read_table(spark, sf, "supplier", ["s_name", "s_acctbal"])
    tradable = (s.where("s_acctbal > 0")
                .select(F.upper(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("symbol"))
                .unionByName(s.where("s_acctbal > 5000").select(
                    F.upper(F.replace("s_name", F.lit("#"), F.lit("."))).alias("symbol"))))
    return dots.unionByName(dashes), tradable


@query("resolve_symbols")
def q_resolve_symbols(spark, sf):
    const, tradable = _variant_const(spark, sf)
    resolved, _ = rd.resolve_symbols(const, tradable, max_symbols=50)
    return resolved


@query("resolve_symbols_all")
def q_resolve_symbols_all(spark, sf):
    """R5 without a limit: every pick, and the counts as extra columns."""
    const, tradable = _variant_const(spark, sf)
    resolved, counts = rd.resolve_symbols(const, tradable)
    n = counts.first()
    return (resolved.withColumn("resolved", F.lit(n["resolved"]).cast("bigint"))
            .withColumn("skipped", F.lit(n["skipped"]).cast("bigint")))


@query("symbol_variants")
def q_symbol_variants(spark, sf):
    const, _ = _variant_const(spark, sf)
    return rd.symbol_variants(const)


@query("trading_calendar")
def q_trading_calendar(spark, sf):
    from barwise.operators.filters import regular_hours
    sessions = rd.sessions_from_bars(regular_hours(fx.bars_a(spark, sf)))
    return rd.build_calendar(sessions, exchanges(spark))


@query("vendor_pages")
def q_vendor_pages(spark, sf):
    return normalise_pages(fx.pages_c(spark, sf))


@query("file_profile")
def q_file_profile(spark, sf):
    """Rows of each input file, by its base name."""
    per_file, _ = profile_input(read_table(spark, sf, "lineitem", ["l_orderkey"]))
    return per_file.select(F.regexp_extract("file_path", "[^/]+$", 0).alias("file"), "rows")


@query("file_sample")
def q_file_sample(spark, sf):
    """The first rows of each input file."""
    _, sample = profile_input(read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"]))
    return sample.select(F.col("row_index").cast("bigint").alias("row_index"), "l_orderkey", "l_linenumber", "l_quantity")


@query("exchange_seed")
def q_exchange_seed(spark, sf):
    seed = exchanges(spark)
    table = mg.insert_ignore(seed, exchanges(spark), ["code"])
    s = read_table(spark, sf, "supplier", ["s_name"]).select(F.col("s_name").alias("symbol"))
    per = (rd.tag_exchange(s, _america_names(spark, sf), out="code")
           .groupBy("code").agg(F.count(F.lit(1)).alias("tickers")))
    return (table.join(per, "code", "left")
            .select("exchange_id", "code", "name",
                    F.coalesce("tickers", F.lit(0).cast("bigint")).alias("tickers")))


__all__ = ["QUERIES", "query"]
