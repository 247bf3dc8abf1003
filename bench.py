"""Benchmark the reference's scenarios on stored bar tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Setup (timed separately, not in the metric): fixture A's five-minute bars
and fixture B's daily bars are loaded into month-partitioned Parquet tables
clustered by (ticker_id, ts), and the daily rollup of A is stored, as the
reference loads bar_5m and builds bar_1d before its scenarios run.

Each scenario is timed as the best of five runs (BENCH_RUNS). A run executes
the whole plan and writes every result row to Spark's ``noop`` sink, so the time is
the engine's work for all rows and columns, without the Python driver's
per-row transfer (the volatility scan returns 533k rows at sf0.1; the
reference's fetch was 78 rows for one symbol). Prints one JSON line whose
"value" is the total of the reference's seven scenarios (``CORE``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from barwise import fixtures as fx  # noqa: E402
from barwise.functions.numeric import round6  # noqa: E402
from barwise.plans import chart as ch  # noqa: E402
from barwise.plans import cross_section as cs  # noqa: E402
from barwise.plans import market as mk  # noqa: E402
from barwise.plans import movers as mv  # noqa: E402
from barwise.plans import rollup as ru  # noqa: E402
from barwise.plans.volatility import volatility_scan  # noqa: E402
from barwise.session import local_session, scratch_path  # noqa: E402
from barwise.sinks import layout as lay  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
# The reference's scenarios; "value" is their total. The other entries are
# comparisons (window form, unpruned read) and full rollup builds.
CORE = ["q01_ticker_chart", "q02_cross_section", "q03_top_movers", "q06_volatility_scan",
        "q09_daily_rollup", "q09b_daily_rollup_stored", "q10_market_volume"]


def store_bars(bars, path, start, end):
    routed = lay.assign_month(bars, start, end)
    lay.write_partitioned(lay.cluster(routed), path)


def best_of(fn, runs=RUNS):
    best = None
    for _ in range(runs):
        t = time.perf_counter()
        fn().write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t
        best = dt if best is None else min(best, dt)
    return best, fn().count()


def input_bytes(sf_dir: str) -> int:
    names = ("events", "customer", "nation", "region", "supplier", "lineitem")
    total = 0
    for n in names:
        path = os.path.join(sf_dir, f"{n}.parquet")
        for root, _, files in os.walk(path) if os.path.isdir(path) else [("", [], [path])]:
            total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
    return total


def session_settings(sf_dir: str, cpus: int) -> dict:
    """AQE sized to the data, as ``session.scale_settings`` does at scale:
    the advisory partition is a quarter of the input per core (1 MB to
    256 MB), so tiny shuffles collapse into one task while larger ones still
    spread over the cores."""
    advisory = max(1 << 20, min(256 << 20, input_bytes(sf_dir) // (4 * cpus)))
    return {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory)}


def main():
    spark = local_session(CPUS, shuffle_partitions=int(CPUS),
                          extra=session_settings(SF_DIR, int(CPUS)))
    t0 = time.perf_counter()
    p5m, pship, p1d = (scratch_path(spark, n) for n in ("bar_5m", "bar_ship", "bar_1d"))
    store_bars(fx.bars_a(spark, SF_DIR), p5m, "2023-01-01", "2025-01-01")
    store_bars(fx.bars_b(spark, SF_DIR), pship, "1995-01-01", "2002-01-01")
    bar_5m = spark.read.parquet(p5m)
    ru.build_daily(bar_5m.drop("month"), p1d)
    load_sec = time.perf_counter() - t0

    bar_ship = spark.read.parquet(pship)
    bar_1d = spark.read.parquet(p1d)
    dims_a = fx.instruments_a(spark, SF_DIR).cache()  # proven small by the fixture
    dims_b = fx.instruments_b(spark, SF_DIR).cache()
    dims_a.count()
    dims_b.count()

    scenarios = {
        # Q1: one instrument, one week of five-minute bars.
        "q01_ticker_chart": lambda: ch.ticker_chart(
            bar_5m, dims_a, "NATION_7", "2024-01-08 00:00:00", "2024-01-15 00:00:00"),
        # Q2: every instrument's close and prior-day return at one time.
        "q02_cross_section": lambda: cs.cross_section(bar_ship, dims_b, "1998-06-15 00:00:00"),
        # Q3: top 20 movers in a six-hour window.
        "q03_top_movers": lambda: mv.top_movers(
            bar_5m, dims_a, "2024-01-15 14:30:00", "2024-01-15 20:30:00", 20, with_volume=True),
        # Q3 over the whole month, single-pass group-by form against the
        # reference's form (unbounded window per instrument + DISTINCT).
        "q03_top_movers_month": lambda: mv.top_movers(
            bar_5m, dims_a, "2024-01-01 00:00:00", "2024-02-01 00:00:00", 20, with_volume=True),
        "q03_top_movers_month_window_form": lambda: mv.top_movers(
            bar_5m, dims_a, "2024-01-01 00:00:00", "2024-02-01 00:00:00", 20, with_volume=True,
            form="window"),
        # Q6: 20-bar rolling realized volatility, all instruments, whole history.
        "q06_volatility_scan": lambda: volatility_scan(bar_ship, dims_b, 20)
        .withColumn("rv", round6("rv")),
        # Q9: daily OHLCV of one instrument from raw bars, regular hours.
        "q09_daily_rollup": lambda: ru.daily_rollup_for(
            bar_5m, dims_a, "NATION_7", "2024-01-01 00:00:00",
            "2025-01-01 00:00:00"),
        # The same from the stored rollup.
        "q09b_daily_rollup_stored": lambda: ch.daily_chart(
            bar_1d, dims_a, "NATION_7", "2024-01-01", "2025-01-01"),
        # Q10: market-wide volume per bar time over four days.
        "q10_market_volume": lambda: mk.market_volume(
            bar_5m, "2024-01-02 14:30:00", "2024-01-06 00:00:00"),
        # Market volume over one month of the 83-month daily history, with
        # month-partition pruning, and without it (partition column dropped,
        # only the ts range reaches the Parquet reader).
        "q10_market_volume_ship_month": lambda: mk.market_volume(
            bar_ship, "1998-06-01 00:00:00", "1998-07-01 00:00:00"),
        "q10_market_volume_ship_month_unpruned": lambda: mk.market_volume(
            bar_ship.drop("month"), "1998-06-01 00:00:00", "1998-07-01 00:00:00"),
        # All instruments' daily rollup from raw bars (the rollup build).
        "q09_all_daily_rollup": lambda: ru.daily_rollup(bar_5m.drop("month")),
        # Monthly rollup of the long daily history (83 months).
        "q09_monthly_rollup_ship": lambda: ru.rollup(
            bar_ship.drop("month"), "month", "UTC", None).select(
            "ticker_id", "session_date", F.col("vwap")),
    }
    results, rows = {}, {}
    for name, fn in scenarios.items():
        results[name], rows[name] = best_of(fn)
    total = sum(results[k] for k in CORE)
    print(json.dumps({
        "metric": "reference_scenarios_total_best_of_runs",
        "value": round(total, 4),
        "core": CORE,
        "unit": "sec",
        "queries": {k: round(v, 4) for k, v in results.items()},
        "rows": rows,
        "load_sec": round(load_sec, 3),
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
