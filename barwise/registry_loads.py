"""Registered queries of loads, stored tables and their checks.

As in ``barwise.registry``: each takes (spark, sf_dir), reads the driver's
tables through ``barwise.fixtures`` and calls the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.functions.numeric import round6
from barwise.operators import quality as qc
from barwise.operators import refdata as rd
from barwise.operators.filters import drop_blank_symbols
from barwise.operators.joins import resolve_ids
from barwise.plans import movers as mv
from barwise.plans import rollup as ru
from barwise.plans import rollup_state as rs
from barwise.registry import MOVERS_T0, MOVERS_T1, _check_rows, _ev_symbols, _supplier_const, _vendor_rows_b, query
from barwise.session import scratch_path
from barwise.sinks import layout as lay
from barwise.sinks import merge as mg
from barwise.sinks.market_data import load_market_data
from barwise.sources.files import input_schema, read_constituents, read_table

START, END = "1995-01-01", "2002-01-01"


def _table(spark, name: str) -> lay.VersionedTable:
    return lay.VersionedTable(spark, scratch_path(spark, name))


def _shipped(spark, sf, since: str, before: str) -> DataFrame:
    """Fixture B's vendor rows with since <= timestamp < before."""
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    return _vendor_rows_b(spark, sf).where((F.col("timestamp") >= at(since)) & (F.col("timestamp") < at(before)))


def _per_month(table: lay.PlainTable) -> DataFrame:
    return table.read().groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))


def _refused(load) -> bool:
    """Whether a load raised because of its rows."""
    try:
        load()
    except ValueError:
        return True
    return False


@query("load_truncate")
def q_load_truncate(spark, sf):
    """K3: a second load replaces the whole table; months it lacks are gone."""
    dims, table = fx.ticker_b(spark, sf), _table(spark, "truncate")
    lay.load_bars(_shipped(spark, sf, START, "1996-01-01"), dims, table, START, END)
    lay.load_bars(_shipped(spark, sf, "1997-01-01", "1998-01-01"), dims, table, START, END, mode="truncate")
    return _per_month(table)


@query("load_append")
def q_load_append(spark, sf):
    """K3: two overlapping loads appended; keys already stored keep their row,
    and the strict form refuses the second load and changes nothing."""
    dims, table = fx.ticker_b(spark, sf), _table(spark, "append")
    lay.load_bars(_shipped(spark, sf, START, "1996-07-01"), dims, table, START, END)
    later = _shipped(spark, sf, "1996-04-01", "1997-01-01").withColumn("volume", F.col("volume") + 1)
    assert _refused(lambda: lay.load_bars(later, dims, table, START, END, mode="append")) and table.version() == 1
    lay.load_bars(later, dims, table, START, END, mode="append", on_duplicate="first")
    return _per_month(table)


@query("load_refused")
def q_load_refused(spark, sf):
    """A load with keys seen twice or rows that break the rules is
    refused as a whole; counters per kind, and the rows of the table after it."""
    dims, table = fx.ticker_b(spark, sf), _table(spark, "refused")
    good = _shipped(spark, sf, "1996-01-01", "1997-01-01")
    lay.load_bars(good, dims, table, START, END)
    twice = good.unionByName(good.where(F.month("timestamp") == 3))
    bad = good.withColumn("low", F.when(F.month("timestamp") == 5, F.col("high") + 1).otherwise(F.col("low")))
    out = []
    for name, rows in (("duplicates", twice), ("bad_rows", bad)):
        refused = _refused(lambda rows=rows: lay.load_bars(rows, dims, table, START, END))
        report: dict = {}
        other = _table(spark, "counted")
        lay.load_bars(rows, dims, other, START, END, on_duplicate="first", on_bad="keep", report=report)
        out.append((name, refused, report[name]))
    checks = spark.createDataFrame(out, "kind string, refused boolean, found bigint")
    return checks.withColumn("rows", F.lit(table.read().count()).cast("bigint"))


@query("load_counters")
def q_load_counters(spark, sf):
    """K9: the counters of a load in which some symbols are unknown and some
    months lie outside the supported range."""
    report: dict = {}
    dims = fx.ticker_b(spark, sf).where(F.col("ticker_id") % 3 != 0)
    lay.load_bars(_vendor_rows_b(spark, sf), dims, _table(spark, "counters"), "1996-01-01", "2001-01-01", report=report)
    names = ("attempted", "unknown_symbols", "loaded", "default_partition", "duplicates", "bad_rows")
    return spark.createDataFrame([tuple(report[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


@query("merge_counters")
def q_merge_counters(spark, sf):
    """K9: attempted, inserted and matched rows of an insert-ignore."""
    b1, b2 = fx.batches_d(spark, sf)
    return mg.load_report(b1, b2, ["o_orderkey"])


@query("rollup_rebuild")
def q_rollup_rebuild(spark, sf):
    """M2: a full refresh after two months vanished from the bars."""
    bars, table = fx.bars_b(spark, sf), _table(spark, "rebuilt")
    kw = dict(period="month", tz="UTC", session=None)
    ru.build_daily(bars, table, **kw)
    ru.build_daily(bars.where(~F.date_format("ts", "yyyy-MM").isin("1996-02", "1998-06")), table, **kw)
    return table.read().select(*ru.DAILY_COLS).withColumn("vwap", round6(F.col("vwap") + F.lit(1e-8)))


@query("rollup_versions")
def q_rollup_versions(spark, sf):
    """M3: rows of each published version of a refreshed rollup; readers of an
    old version keep it."""
    bars, table = fx.bars_b(spark, sf), _table(spark, "versions")
    kw = dict(period="month", tz="UTC", session=None)
    ru.build_daily(bars.where(F.col("ts") < F.lit("1998-06-15").cast("timestamp_ntz")), table, **kw)
    ru.refresh_daily(bars, table, ["1998-06"], **kw)
    out = None
    for v in (1, 2):
        n = table.read(v).groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume"))
        n = n.where("month >= '1998-05'").withColumn("version", F.lit(v))
        out = n if out is None else out.unionByName(n)
    return out


@query("bars_split")
def q_bars_split(spark, sf):
    """Good rows and quarantined rows with the rules they break."""
    good, bad = qc.check_bars(_check_rows(spark, sf), nonneg_prices=True)
    tags = bad.groupBy(F.array_join(F.array_sort("violations"), ",").alias("violations")).agg(F.count(F.lit(1)).alias("rows"))
    return tags.unionByName(good.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("").alias("violations"), "rows"))


@query("required_values")
def q_required_values(spark, sf):
    """Rows in which a required column is null."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    gone = lambda n: F.when(F.col("o_orderkey") % n != 0, F.col("o_totalprice"))
    rows = o.select(gone(3).alias("open"), F.col("o_totalprice").alias("high"), F.col("o_totalprice").alias("low"),
                    gone(5).alias("close"), F.lit(1).alias("volume"))
    return qc.violation_counts(rows, required=("open", "close", "volume"))


@query("unknown_refs")
def q_unknown_refs(spark, sf):
    """Line items whose supplier is not in a partial supplier list."""
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"]).withColumnRenamed("l_suppkey", "s_suppkey")
    s = read_table(spark, sf, "supplier", ["s_suppkey", "s_acctbal"]).where("s_acctbal > 0")
    return qc.check_refs(li, s, "s_suppkey").groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("rows"))


@query("resolve_ids_drop")
def q_resolve_ids_drop(spark, sf):
    """Rows of unknown symbols are dropped and counted by symbol."""
    ev, dims = _ev_symbols(spark, sf)
    resolved, unknown = resolve_ids(ev, dims, on_unknown="drop")
    kept = resolved.groupBy("ticker_id").agg(F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(unknown.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(None).cast("bigint").alias("ticker_id"), "rows"))


@query("blank_symbols")
def q_blank_symbols(spark, sf):
    """Rows whose symbol is null, empty or blank are left out."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    k = F.col("o_orderkey") % 4
    rows = o.select("o_orderkey", F.when(k == 0, None).when(k == 1, "").when(k == 2, "  ").otherwise(F.col("o_orderpriority")).alias("symbol"))
    return drop_blank_symbols(rows).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))


@query("top_movers_window")
def q_top_movers_window(spark, sf):
    """First and last value over one named window, then distinct."""
    bars, dims = fx.bars_a(spark, sf, MOVERS_T0, MOVERS_T1), fx.instruments_a(spark, sf)
    return mv.top_movers(bars, dims, MOVERS_T0, MOVERS_T1, 20, with_volume=True, form="window")


def _constituents_csv(spark, sf) -> str:
    """Fixture B's suppliers as CSV files with a header, each symbol listed twice."""
    path = scratch_path(spark, "constituents")
    c = _supplier_const(spark, sf).select("Symbol", "Security", "GICS Sector", "GICS Sub-Industry", "CIK")
    first = c.withColumn("Security", F.concat("Security", F.lit(", old"))).withColumn("_turn", F.lit(0))
    rows = first.unionByName(c.withColumn("_turn", F.lit(1))).repartitionByRange(3, "_turn", "Symbol").sortWithinPartitions("_turn", "Symbol")
    rows.drop("_turn").write.option("header", True).csv(path)
    return path


@query("constituents_csv")
def q_constituents_csv(spark, sf):
    """A constituents CSV read as text, seeded as tickers; of a
    symbol listed twice the last row in file order wins."""
    from barwise.sources.seed import exchanges
    const = read_constituents(spark, _constituents_csv(spark, sf), numbered=True)
    sectors = rd.build_sectors(const)
    t = rd.build_tickers(const, sectors, rd.build_industries(const, sectors), exchanges(spark))
    return t.select("symbol", "name", "cik", "headquarters", "date_added")


@query("missing_columns")
def q_missing_columns(spark, sf):
    """Which of the required columns a constituents file lacks."""
    path = scratch_path(spark, "short")
    _supplier_const(spark, sf).select("Symbol", "CIK").write.option("header", True).csv(path)
    try:
        read_constituents(spark, path)
    except ValueError as e:
        lacking = [c for c in ("CIK", "GICS Sector", "Security", "Symbol") if repr(c) in str(e)]
        return spark.createDataFrame([(c,) for c in lacking], "missing string")
    raise AssertionError("a file without required columns was read")


@query("input_schema")
def q_input_schema(spark, sf):
    """Columns and types of an input."""
    return input_schema(spark.read.parquet(f"{sf}/lineitem.parquet")).where("column LIKE 'l_%key' OR column = 'l_shipdate'").select("position", "column", "type")


@query("insert_order")
def q_insert_order(spark, sf):
    """The second loader's files hold each month's rows by (ts, symbol_id).
    Rows and rows out of order, by month, read back in file order."""
    path, syms = scratch_path(spark, "sorted"), scratch_path(spark, "symbols")
    meta = _supplier_const(spark, sf).select(F.col("Symbol").alias("symbol"), F.col("Security").alias("name"), F.col("GICS Sector").alias("sector"))
    load_market_data(_vendor_rows_b(spark, sf), meta, path, syms, "1996-01-01", "2001-01-01")
    rows = spark.read.parquet(path).select("month", "ts", "symbol_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    before = F.lag(F.struct("ts", "symbol_id")).over(Window.partitionBy("file").orderBy("place"))  # a file is one task's output
    rows = rows.withColumn("late", before > F.struct("ts", "symbol_id"))
    return rows.groupBy("month").agg(F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("out_of_order"))


@query("rollup_incremental")
def q_rollup_incremental(spark, sf):
    """M3: fixture A's bars in three batches that cut days in two, merged as
    states; a batch run again changes nothing."""
    bars, table = fx.bars_a(spark, sf), _table(spark, "states")
    minute = F.minute("ts")
    cuts = [minute < 20, (minute >= 20) & (F.dayofmonth("ts") <= 15), (minute >= 20) & (F.dayofmonth("ts") > 15)]
    for i, cut in enumerate(cuts):
        assert rs.apply_bars(table, bars.where(cut), i)
        assert not rs.apply_bars(table, bars.where(cut), i)
    return rs.finished(table.read()).withColumn("vwap", round6("vwap"))


@query("stream_incremental")
def q_stream_incremental(spark, sf):
    """M3, K7 driven by landed files: overlapping batches, mergeable states."""
    from barwise.streaming import start_refresh
    bars = fx.bars_a(spark, sf)
    landing, ckpt, fact, state = (scratch_path(spark, n) for n in ("landing", "stream-ckpt", "fact", "states"))
    cut = F.lit("2024-01-16 18:00:00").cast("timestamp_ntz")
    for i, rows in enumerate((bars.where(F.col("ts") < cut), bars.where(F.col("ts") >= cut - F.expr("INTERVAL 2 DAYS")))):
        rows.write.parquet(f"{landing}/batch={i}")
        start_refresh(spark, landing, fact, state, "2023-01-01", "2025-01-01", ckpt, incremental=True).awaitTermination()
    return rs.finished(lay.read_partitioned(spark, state)).withColumn("vwap", round6("vwap"))


@query("upsert_partitioned")
def q_upsert_partitioned(spark, sf):
    """K8: the second batch of orders upserted into a table by year; with each
    year, whether its files are those of the first load."""
    year = F.date_format("o_orderdate", "yyyy")
    b1, b2 = (b.withColumn("year", year) for b in fx.batches_d(spark, sf))
    table = lay.VersionedTable(spark, scratch_path(spark, "orders"), "year")
    mg.upsert_table(table, b1, ["o_orderkey"])
    before = table.manifest()["folders"]
    mg.upsert_table(table, b2, ["o_orderkey"])
    after = table.manifest()["folders"]
    kept = F.col("year").isin([y for y in after if after[y] == before.get(y)])
    return table.read().select(*fx.ORDER_COLS, kept.alias("files_kept"))
