"""Tables after repeated loads and refreshes, unrounded money, pruned reads, bounded blocks."""

import pytest
from pyspark.sql import functions as F

from barwise.operators import bars as ob
from barwise.operators import refdata as rd
from barwise.operators import windows as ow
from barwise.operators.filters import for_symbol
from barwise.operators.numbering import number_rows
from barwise.plans import rollup as ru
from barwise.session import scratch_path
from barwise.sinks import layout as lay

from .conftest import bars_df, dims_df, ts

VENDOR = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, vwap double, trade_count bigint"


def vendor(spark, *rows):
    return spark.createDataFrame([(s, ts(t), c, c, c, c, 10, c, 1) for s, t, c in rows], VENDOR)


def keys(spark, path):
    return sorted((r.ticker_id, str(r.ts)) for r in spark.read.parquet(path).collect())


def load(b, d, path, **kw):
    return lay.load_bars(b, d, path, "2023-01-01", "2025-01-01", **kw)


def test_ticks_below_the_cent_keep_their_price(spark):
    t = spark.createDataFrame([(1, ts("2024-01-02 15:00"), 0.004, 100), (1, ts("2024-01-02 15:01"), 10.005, 100)],
                              "ticker_id int, ts timestamp_ntz, price double, size bigint")
    assert ob.bars_from_ticks(t).first().vwap == pytest.approx(5.0045, abs=1e-12)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_huge_bars_roll_up(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        b = bars_df(spark, [(1, "2024-01-02 15:00", 2e6, 2e6, 2e6, 2e6, 1_000_000, 2e6, 1)])
        assert ru.daily_rollup(b).first().vwap == 2e6
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_append_checks_stored_keys(spark):
    d, path = dims_df(spark, [(1, "AA"), (2, "BB")]), scratch_path(spark, "append")
    one = vendor(spark, ("AA", "2024-01-02 15:00", 1.0), ("BB", "2024-01-02 15:00", 2.0))
    load(one, d, path)
    with pytest.raises(ValueError):
        load(one, d, path, mode="append")
    load(vendor(spark, ("AA", "2024-01-02 15:00", 9.0), ("AA", "2024-02-02 15:00", 3.0)), d, path, mode="append", on_duplicate="first")
    assert keys(spark, path) == [(1, "2024-01-02 15:00:00"), (1, "2024-02-02 15:00:00"), (2, "2024-01-02 15:00:00")]
    assert spark.read.parquet(path).where("ticker_id = 1 and month = '2024-01'").first().close == 1.0


def test_truncate_replaces_overwrite_keeps_other_months(spark):
    d, path = dims_df(spark, [(1, "AA")]), scratch_path(spark, "truncate")
    load(vendor(spark, ("AA", "2023-01-03 15:00", 1.0)), d, path)
    load(vendor(spark, ("AA", "2024-05-03 15:00", 1.0)), d, path)
    assert len(keys(spark, path)) == 2
    load(vendor(spark, ("AA", "2024-06-03 15:00", 1.0)), d, path, mode="truncate")
    assert keys(spark, path) == [(1, "2024-06-03 15:00:00")]


def test_bad_rows_fail_or_drop(spark):
    d, path = dims_df(spark, [(1, "AA")]), scratch_path(spark, "bad")
    b = vendor(spark, ("AA", "2024-01-03 15:00", 1.0), ("AA", "2024-01-03 15:05", 1.0))
    b = b.withColumn("high", F.when(F.col("timestamp") == F.lit("2024-01-03 15:05").cast("timestamp_ntz"), F.lit(0.5)).otherwise(F.col("high")))
    with pytest.raises(ValueError):
        load(b, d, path, on_bad="fail")
    load(b, d, path, on_bad="drop")
    assert keys(spark, path) == [(1, "2024-01-03 15:00:00")]


def test_rebuild_and_refresh_forget_empty_months(spark):
    rows = [(1, "2024-01-03 15:00", 1, 1, 1, 1, 10, 1.0, 1), (1, "2024-02-05 15:00", 2, 2, 2, 2, 10, 2.0, 1)]
    path = scratch_path(spark, "daily")
    ru.build_daily(bars_df(spark, rows), path)
    later = bars_df(spark, rows[1:])
    ru.refresh_daily(later, path, ["2024-01", "2024-02"])
    assert [str(r.session_date) for r in spark.read.parquet(path).collect()] == ["2024-02-05"]
    ru.build_daily(bars_df(spark, rows), path)
    ru.build_daily(later, path)
    assert [str(r.session_date) for r in spark.read.parquet(path).collect()] == ["2024-02-05"]


def test_hot_month_is_split_and_results_hold(spark):
    b = spark.range(4000).select(F.lit(1).alias("ticker_id"), (F.timestamp_seconds(F.lit(1704200000) + F.col("id") * 300)).alias("ts"),
                                 (100 + F.sin(F.col("id").cast("double"))).alias("close"))
    blocks = ow.block_table(b.select("ticker_id", "ts"), 20, block_rows=400)
    sizes = ow.blocked(b, blocks).groupBy("_blk").count().agg(F.max("count")).first()[0]
    assert sizes <= 400
    for drop in (False, True):
        cut = {r.ts: r.rv for r in ow.rolling_vol(b, 20, drop, block_rows=400).collect()}
        whole = {r.ts: r.rv for r in ow.rolling_vol(b, 20, drop).collect()}
        assert cut.keys() == whole.keys()
        assert all((x is None and whole[t] is None) or abs(x - whole[t]) < 1e-12 for t, x in cut.items())


def test_symbol_reaches_the_scan_without_a_join(spark):
    d, path = dims_df(spark, [(1, "AA"), (2, "BB")]), scratch_path(spark, "pushed")
    load(vendor(spark, ("AA", "2024-01-02 15:00", 1.0), ("BB", "2024-01-02 15:00", 2.0)), d, path)
    got = for_symbol(spark.read.parquet(path), d, ["AA", "none"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ticker_id" in plan.split("PushedFilters")[1][:80] and "Join" not in plan
    assert [(r.symbol, r.close) for r in got.collect()] == [("AA", 1.0)]
    assert for_symbol(spark.read.parquet(path), d, "none").collect() == []


def test_numbers_follow_the_order_over_partitions(spark):
    df = spark.createDataFrame([(f"n{i:03d}",) for i in range(200)], "name string").repartition(7)
    got = number_rows(df, ["name"], "no")
    assert sorted((r.no, r.name) for r in got.collect()) == [(i + 1, f"n{i:03d}") for i in range(200)]
    plan = rd.assign_ids(df)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]


def test_last_row_of_a_symbol_wins(spark):
    const = spark.createDataFrame([(1, "AA", "Old", "S", "I", "1", "", ""), (2, "BB", "B", "S", "I", "2", "", ""), (3, "AA", "New", "S", "I", "3", "", "")],
                                  ["row_no", "Symbol", "Security", "GICS Sector", "GICS Sub-Industry", "CIK", "Headquarters Location", "Date added"])
    sec = rd.build_sectors(const)
    ind = rd.build_industries(const, sec)
    ex = spark.createDataFrame([(1, "XNYS"), (2, "XNAS")], "exchange_id int, code string")
    t = rd.build_tickers(const, sec, ind, ex)
    assert sorted((r.symbol, r.name) for r in t.collect()) == [("AA", "New"), ("BB", "B")]
