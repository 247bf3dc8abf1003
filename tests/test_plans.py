"""Plan shape and invariants: pruning, pushdown, no single-partition
windows, rollup table equals raw rollup, refresh equals full build."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.operators.filters import time_range
from barwise.plans import chart as ch
from barwise.plans import cross_section as cs
from barwise.plans import market as mk
from barwise.plans import movers as mv
from barwise.plans import rollup as ru
from barwise.plans.volatility import volatility_scan
from barwise.session import scratch_path
from barwise.sinks import layout as lay
from barwise.sinks.merge import append_new

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    """Fixture A and B loaded as month-partitioned tables."""
    p5, pb = scratch_path(spark, "t5m"), scratch_path(spark, "tship")
    lay.write_partitioned(lay.cluster(lay.assign_month(fx.bars_a(spark, SF), "2023-01-01",
                                                       "2025-01-01")), p5)
    lay.write_partitioned(lay.cluster(lay.assign_month(fx.bars_b(spark, SF), "1995-01-01",
                                                       "2002-01-01")), pb)
    return spark.read.parquet(p5), spark.read.parquet(pb), pb


def test_time_range_prunes_months_and_pushes_filters(spark, stored):
    _, ship, _ = stored
    df = time_range(ship, "1998-06-01 00:00:00", "1998-07-01 00:00:00").select("ticker_id", "close")
    p = plan(df)
    parts = p[p.index("PartitionFilters: ["):].split("]")[0]
    assert "month" in parts and "1998-06" in parts and "default" in parts
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    # Column pruning: only the needed columns are read.
    assert "ReadSchema: struct<ticker_id:int,ts:timestamp_ntz,close:double>" in p


def test_volatility_has_no_single_partition_exchange(spark, stored):
    _, ship, _ = stored
    dims = fx.instruments_b(spark, SF)
    # Input larger than a block: windows run per (instrument, block).
    df = volatility_scan(ship, dims, 20, block_rows=500)
    df.write.format("noop").mode("overwrite").save()
    p = plan(df)
    assert "SinglePartition" not in p
    assert "hashpartitioning(ticker_id" in p and "_blk" in p
    # Input that fits one block: a plain per-instrument window.
    small = volatility_scan(ship, dims, 20)
    small.write.format("noop").mode("overwrite").save()
    assert "SinglePartition" not in plan(small)


def test_top_movers_is_partial_aggregate_and_top_n(spark, stored):
    bars, _, _ = stored
    df = mv.top_movers(bars, fx.instruments_a(spark, SF), "2024-01-15 14:30:00",
                       "2024-01-15 20:30:00", 20)
    df.collect()
    p = plan(df)
    assert "TakeOrderedAndProject" in p
    assert "partial_min_by" in p and "Window" not in p


def test_market_volume_pushes_range_to_scan(spark, stored):
    bars, _, _ = stored
    df = mk.market_volume(bars, "2024-01-02 14:30:00", "2024-01-06 00:00:00")
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert "PushedFilters" in p and "LessThan(ts" in p


def test_stored_rollup_equals_raw_and_refresh_equals_full(spark):
    bars = fx.bars_b(spark, SF)
    kw = dict(period="month", tz="UTC", session=None)
    full = scratch_path(spark, "full")
    ru.build_daily(bars, full, **kw)
    part = scratch_path(spark, "part")
    ru.build_daily(bars.where(F.date_format("ts", "yyyy-MM") != "1999-03"), part, **kw)
    ru.refresh_daily(bars, part, ["1999-03"], **kw)
    a = spark.read.parquet(full).select(*ru.DAILY_COLS)
    b = spark.read.parquet(part).select(*ru.DAILY_COLS)
    r = ru.compare(a, b).first()
    assert (r.only_left, r.only_right) == (0, 0)
    raw = ru.rollup(bars, **kw)
    r = ru.compare(raw, a).first()
    assert (r.only_left, r.only_right) == (0, 0)
    # A refresh that reads the table it replaces is refused.
    with pytest.raises(ValueError):
        ru.refresh_daily(spark.read.parquet(full).withColumnRenamed("session_date", "ts"),
                         full, ["1999-03"], **kw)


def test_volume_is_conserved_from_bars_to_days(spark):
    from barwise.operators.filters import regular_hours
    bars = fx.bars_a(spark, SF)
    days = ru.daily_rollup(bars)
    assert days.agg(F.sum("volume")).first()[0] == \
        regular_hours(bars).agg(F.sum("volume")).first()[0]


def test_rollup_read_is_cheaper_than_raw_rollup(spark, stored):
    bars, _, _ = stored
    p = scratch_path(spark, "d1")
    ru.build_daily(bars.drop("month"), p)
    daily = spark.read.parquet(p)
    dims = fx.instruments_a(spark, SF)
    q9b = ch.daily_chart(daily, dims, "NATION_7", "2024-01-01", "2025-01-01")
    q9 = ru.daily_rollup_for(bars, dims, "NATION_7", "2024-01-01 00:00:00",
                             "2025-01-01 00:00:00")
    # Same answer; the stored read has no aggregate at all.
    a = q9b.drop("vwap").collect()
    b = q9.collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]
    assert "Aggregate" not in plan(q9b)


def test_append_new_second_load_changes_nothing(spark):
    path = scratch_path(spark, "orders")
    b1, b2 = fx.batches_d(spark, SF)
    b1.write.parquet(path)
    t = spark.read.parquet(path)
    n1 = append_new(path, t, b2, ["o_orderkey"]).count()
    after = spark.read.parquet(path)
    assert after.count() == b1.count() + n1
    n2 = append_new(path, after, b2, ["o_orderkey"]).count()
    assert n2 == 0 and spark.read.parquet(path).count() == after.count()


def test_load_bars_writes_month_folders_sorted(spark):
    path = scratch_path(spark, "load")
    vendor = fx.vendor_rows_a(spark, SF)
    dims = fx.instruments_a(spark, SF)
    report = {}
    counts = lay.load_bars(vendor, dims, path, "2024-01-01", "2024-01-15", report=report)
    got = {r.month: r.rows for r in counts.collect()}
    assert set(got) == {"2024-01", "default"}
    assert sum(got.values()) == vendor.count()
    assert report["attempted"] == report["loaded"] == vendor.count()
    assert report["unknown_symbols"] == 0 and report["default_partition"] == got["default"]
    assert os.path.isdir(os.path.join(path, "month=2024-01"))


def test_load_bars_duplicate_keys(spark):
    import datetime as dt
    rows = [("NATION_1", dt.datetime(2024, 1, 2, 14, 30), 1.0, 2.0, 0.5, 1.5, 10, 1.2, 1),
            ("NATION_1", dt.datetime(2024, 1, 2, 14, 30), 1.1, 2.0, 0.5, 1.5, 10, 1.2, 1),
            ("NATION_1", dt.datetime(2024, 1, 2, 14, 35), 1.0, 2.0, 0.5, 1.5, 10, 1.2, 1),
            ("NOPE", dt.datetime(2024, 1, 2, 14, 35), 1.0, 2.0, 0.5, 1.5, 10, 1.2, 1)]
    vendor = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, "
                                   "high double, low double, close double, volume long, "
                                   "vwap double, trade_count long")
    dims = fx.instruments_a(spark, SF)
    with pytest.raises(ValueError, match="duplicate keys"):
        lay.load_bars(vendor, dims, scratch_path(spark, "dup"), "2024-01-01", "2025-01-01")
    path = scratch_path(spark, "dup")
    report = {}
    lay.load_bars(vendor, dims, path, "2024-01-01", "2025-01-01", on_duplicate="first",
                  report=report)
    got = sorted((r.ts.minute, r.open) for r in spark.read.parquet(path).collect())
    assert got == [(30, 1.0), (35, 1.0)]
    assert (report["attempted"], report["unknown_symbols"], report["loaded"]) == (3, 1, 2)


def test_top_movers_group_form_equals_window_form(spark, stored):
    bars, _, _ = stored
    dims = fx.instruments_a(spark, SF)
    args = (bars, dims, "2024-01-10 00:00:00", "2024-01-20 00:00:00", 25, True)
    a = [tuple(r) for r in mv.top_movers(*args).collect()]
    b = [tuple(r) for r in mv.top_movers(*args, form="window").collect()]
    assert a == b and len(a) > 0


def test_partition_stats_and_files(spark, stored):
    from barwise.operators.aggregates import files_per_partition, partition_stats
    _, ship, _ = stored
    stats = {r.month: r for r in partition_stats(ship).collect()}
    files = {r.month: r for r in files_per_partition(ship).collect()}
    assert set(stats) == set(files) and len(stats) == 83
    assert sum(r.rows for r in stats.values()) == ship.count()
    assert all(r.files >= 1 and r.bytes > 0 for r in files.values())


def test_month_pruning_keeps_default_partition(spark):
    from tests.conftest import bars_df
    b = bars_df(spark, [(1, "2022-12-30 15:00", 1, 1, 1, 1, 1), (1, "2023-01-03 15:00", 1, 1, 1, 1, 1),
                        (1, "2023-03-03 15:00", 1, 1, 1, 1, 1)])
    path = scratch_path(spark, "dflt")
    lay.write_partitioned(lay.assign_month(b, "2023-01-01", "2025-01-01"), path)
    t = spark.read.parquet(path)
    assert time_range(t, "2022-12-01 00:00:00", "2023-02-01 00:00:00").count() == 2
    from barwise.operators.filters import at_time
    assert at_time(t, "2022-12-30 15:00:00").count() == 1
    p = plan(time_range(t, "2023-03-01 00:00:00", "2023-04-01 00:00:00"))
    assert "PartitionFilters" in p and "2023-03" in p


def test_refresh_prunes_bar_months(spark, stored):
    _, ship, pb = stored
    from barwise.operators.filters import time_range
    near = time_range(ship, "1999-02-28 00:00:00", "1999-04-02 00:00:00")
    parts = plan(near)
    parts = parts[parts.index("PartitionFilters: ["):].split("]")[0]
    assert "1999-03" in parts and "1999-06" not in parts
    kw = dict(period="month", tz="UTC", session=None)
    out = scratch_path(spark, "refresh")
    ru.refresh_daily(ship, out, ["1999-03"], **kw)
    got = spark.read.parquet(out)
    assert {r.month for r in got.select("month").distinct().collect()} == {"1999-03"}
    want = ru.rollup(ship, **kw).where(F.col("session_date") == F.lit("1999-03-01").cast("date"))
    r = ru.compare(want, got.select(*ru.DAILY_COLS)).first()
    assert (r.only_left, r.only_right) == (0, 0)


def test_second_loader_rules(spark):
    import datetime as dt
    from barwise.sinks.market_data import load_market_data
    cols = ("symbol string, timestamp timestamp_ntz, open double, high double, low double, "
            "close double, volume long, vwap double, trade_count long")
    t = dt.datetime
    rows = [("AAA", t(2023, 6, 1, 14, 30), 1.1234567, 2.0, 1.0, 1.5, 10, None, None),
            ("AAA", t(2023, 6, 1, 14, 30), 1.0, 2.0, 1.0, 1.5, 10, None, None),   # duplicate key
            ("ZZZ", t(2023, 6, 1, 14, 30), 3.0, 3.0, 3.0, 3.0, 5, None, None),    # unknown symbol
            ("AAA", t(2022, 12, 30, 14, 30), 1.0, 1.0, 1.0, 1.0, 1, None, None)]  # out of range
    vendor = spark.createDataFrame(rows, cols)
    meta = spark.createDataFrame([("AAA", "Triple A", "Tech")], "symbol string, name string, "
                                 "sector string")
    path, syms = scratch_path(spark, "md"), scratch_path(spark, "syms")
    r1 = load_market_data(vendor, meta, path, syms, "2023-01-01", "2025-01-01")
    assert (r1["attempted"], r1["out_of_range"], r1["inserted"], r1["symbols"]) == (3, 1, 2, 2)
    s = {x.ticker: (x.company_name, x.sector) for x in spark.read.parquet(syms).collect()}
    assert s == {"AAA": ("Triple A", "Tech"), "ZZZ": ("ZZZ", "Unknown")}
    md = spark.read.parquet(path)
    assert str(md.schema["open"].dataType) == "DecimalType(18,6)"
    kept = {x.symbol_id: float(x.open) for x in md.collect()}
    assert sorted(kept.values()) == [1.0, 3.0]          # first of the duplicate key kept
    meta2 = spark.createDataFrame([("AAA", "Triple A Inc", "Tech"), ("ZZZ", "Zed", "Energy")],
                                  "symbol string, name string, sector string")
    r2 = load_market_data(vendor, meta2, path, syms, "2023-01-01", "2025-01-01")
    assert (r2["attempted"], r2["inserted"]) == (3, 0)
    s = {x.ticker: (x.symbol_id, x.company_name, x.sector) for x in spark.read.parquet(syms).collect()}
    assert s["ZZZ"][1:] == ("Zed", "Energy") and s["AAA"][1] == "Triple A Inc"


def test_second_loader_reads_its_batch_once(spark):
    from barwise.sinks.market_data import load_market_data
    cols = ("symbol string, timestamp timestamp_ntz, open double, high double, low double, "
            "close double, volume long, vwap double, trade_count long")
    rows = [(f"S{i % 3}", dt.datetime(2023, 1 + i % 5, 1), 1.0, 2.0, 1.0, 1.5, i, None, None) for i in range(15)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    vendor = spark.createDataFrame(rows, cols).mapInArrow(counted, cols)
    meta = spark.createDataFrame([("S0", "S nought", "Tech")], "symbol string, name string, sector string")
    path, syms = scratch_path(spark, "md"), scratch_path(spark, "syms")
    for inserted in (12, 0):
        read.value = 0
        r = load_market_data(vendor, meta, path, syms, "2023-01-01", "2023-05-01")
        assert (r["attempted"], r["out_of_range"], r["inserted"], r["symbols"]) == (12, 3, inserted, 3)
        assert read.value == 15
    assert sorted(x.volume for x in spark.read.parquet(path).collect()) == [i for i in range(15) if i % 5 < 4]


def test_first_by_values_equals_least_rows(spark):
    from barwise.sinks.merge import first_by_values
    rng = random.Random(5)
    rows = [(rng.randrange(30), *[rng.choice([None, 1, 2]) for _ in range(3)]) for _ in range(60)]
    rows += [(99, None, None, None)] * 2 + [(98, None, 1, 1), (98, 1, None, 1), (None, 2, 1, 1), (None, 1, 2, 2)]
    by_key = {}
    for k, *v in rows:
        by_key.setdefault(k, []).append(v)
    least = {k: (min(vs, key=lambda v: [(x is not None, x or 0) for x in v]), len(vs)) for k, vs in by_key.items()}
    once = {k: (v, 1) for k, (v, _) in least.items()}
    for given, want in ((rows, least), ([(k, *v) for k, (v, _) in least.items()], once)):
        df = spark.createDataFrame(given, "k int, a int, b int, c int")
        got = first_by_values(df, ["k"], ["a", "b", "c"], scratch_path(spark, "first"), "n").collect()
        assert len(got) == len(want) and {r.k: ([r.a, r.b, r.c], r.n) for r in got} == want


def test_day_partitions_prune_cross_sections(spark):
    from barwise.operators.filters import at_times
    vendor = fx.vendor_rows_a(spark, SF)
    dims = fx.instruments_a(spark, SF)
    by_month, by_day = scratch_path(spark, "m"), scratch_path(spark, "d")
    lay.load_bars(vendor, dims, by_month, "2023-01-01", "2025-01-01")
    lay.load_bars(vendor, dims, by_day, "2023-01-01", "2025-01-01", by_day=True)
    m, d = spark.read.parquet(by_month), spark.read.parquet(by_day)
    assert os.path.isdir(os.path.join(by_day, "month=2024-01", "day=2024-01-16"))
    q = lambda t: cs.cross_section(t, dims, "2024-01-16 19:55:00").collect()
    assert [tuple(r) for r in q(m)] == [tuple(r) for r in q(d)]
    p = plan(at_times(d, ["2024-01-16 19:55:00"]))
    parts = p[p.index("PartitionFilters: ["):].split("]")[0]
    assert "2024-01-16" in parts and "day" in parts
    r = lambda t: mk.market_volume(t, "2024-01-02 14:30:00", "2024-01-06 00:00:00").collect()
    assert r(m) == r(d)
    p = plan(time_range(d, "2024-01-02 14:30:00", "2024-01-06 00:00:00"))
    parts = p[p.index("PartitionFilters: ["):].split("]")[0]
    assert "2024-01-05" in parts and "2024-01-07" not in parts
    # With out-of-range rows the day column is a string ('default' folder).
    mixed = scratch_path(spark, "dm")
    lay.load_bars(vendor, dims, mixed, "2024-01-01", "2024-01-15", by_day=True)
    x = spark.read.parquet(mixed)
    assert x.schema["day"].dataType.simpleString() == "string"
    assert time_range(x, "2024-01-10 00:00:00", "2024-01-20 00:00:00").count() == \
        time_range(m, "2024-01-10 00:00:00", "2024-01-20 00:00:00").count()
