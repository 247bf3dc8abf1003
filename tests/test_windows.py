"""Windows over chunks of time and their edges."""

import datetime as dt
import math
import random

import pytest

from barwise.operators import windows as ow
from barwise.plans.volatility import volatility_scan

from .conftest import dims_df, ts

SCHEMA = "ticker_id int, ts timestamp_ntz, close double"


def plain(rows, n, drop_first):
    """Row by row: (ticker, ts) -> (logret, rv)."""
    out, by = {}, {}
    for r in sorted(rows, key=lambda r: r[1]):
        by.setdefault(r[0], []).append(r)
    for t, rs in by.items():
        rets = [None]
        for a, b in zip(rs, rs[1:]):
            ok = None not in (a[2], b[2]) and a[2] != 0 and b[2] / a[2] > 0
            rets.append(math.log(b[2] / a[2]) if ok else None)
        seq = [(r[1], g) for r, g in zip(rs, rets) if g is not None or not drop_first]
        for i, (at, g) in enumerate(seq):
            frame = [x for _, x in seq[max(0, i - n + 1):i + 1] if x is not None]
            out[t, at] = (g, math.sqrt(sum(x * x for x in frame)) if frame else None)
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for k, pair in want.items():
        for a, b in zip(got[k], pair):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9), k


def make(seed, gaps):
    """Bars of a few instruments with gaps of the given seconds, and closes that give no return."""
    rng = random.Random(seed)
    rows = []
    for t in range(4):
        at = ts("2023-12-30 22:00:00")
        for _ in range((1, 5, 60, 300)[t]):
            at += dt.timedelta(seconds=rng.choice(gaps))
            rows.append((t, at, rng.choice([None, 0.0, -1.0]) if rng.random() < 0.15 else rng.uniform(1, 9)))
    return rows


@pytest.mark.parametrize("drop", [False, True])
@pytest.mark.parametrize("n", [1, 2, 7])
@pytest.mark.parametrize("block_rows,gaps", [(10, (1, 2, 40)), (60, (300, 900)), (1440, (3600, 40000)), (10**6, (86400, 900000))])
def test_equals_row_by_row(spark, drop, n, block_rows, gaps):
    rows = make(n * 31 + block_rows, gaps)
    got = ow.rolling_vol(spark.createDataFrame(rows, SCHEMA).repartition(5), n, drop, block_rows=block_rows)
    same({(r.ticker_id, r.ts): (r.logret, r.rv) for r in got.collect()}, plain(rows, n, drop))


def test_a_chunk_without_any_return_is_crossed(spark):
    """Whole days of closes without a return between two good ones, frames of three."""
    rows = [(1, ts(f"2024-01-0{d} {h:02d}:00:00"), None if 2 <= d <= 4 else float(d * h + 1)) for d in range(1, 7) for h in (9, 12, 15)]
    for drop in (False, True):
        got = ow.rolling_vol(spark.createDataFrame(rows, SCHEMA), 3, drop, block_rows=1440)
        same({(r.ticker_id, r.ts): (r.logret, r.rv) for r in got.collect()}, plain(rows, 3, drop))


def test_log_returns_keep_all_columns(spark):
    rows = make(5, (300, 4000))
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", extra int")
    got = ow.log_returns(df, block_rows=60).collect()
    assert sorted(r.extra for r in got) == list(range(len(rows)))
    same({(r.ticker_id, r.ts): (r.logret, 0.0) for r in got}, {k: (v[0], 0.0) for k, v in plain(rows, 1, False).items()})


def test_counted_blocks_agree(spark):
    rows = make(9, (1, 300))
    df = spark.createDataFrame(rows, SCHEMA)
    for drop in (False, True):
        got = ow.rolling_vol(df, 4, drop, block_rows=40, counted=True).collect()
        same({(r.ticker_id, r.ts): (r.logret, r.rv) for r in got}, plain(rows, 4, drop))


def test_small_files_get_the_plain_window(spark, tmp_path):
    rows = make(4, (300,))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"file://{tmp_path}/t")
    df = spark.read.parquet(f"file://{tmp_path}/t")
    assert ow.is_small(df, 10**6) and not ow.is_small(df, 10) and not ow.is_small(spark.createDataFrame(rows, SCHEMA), 10**6)
    for drop in (False, True):
        got = ow.rolling_vol(df, 4, drop)
        assert "Union" not in got._jdf.queryExecution().executedPlan().toString()
        same({(r.ticker_id, r.ts): (r.logret, r.rv) for r in got.collect()}, plain(rows, 4, drop))
    assert len(ow.log_returns(df).collect()) == len(rows)


def test_chunk_grain_follows_the_bars(spark):
    assert ow.chunk_grain() == "year"
    assert ow.chunk_grain(1_000_000, dt.timedelta(seconds=1)) == "day"
    assert ow.chunk_grain(500, dt.timedelta(days=1)) == "year"
    assert ow.chunk_grain(1, dt.timedelta(milliseconds=1)) == "second"


def test_building_a_query_starts_no_job(spark):
    df, dims = spark.createDataFrame(make(3, (300,)), SCHEMA), dims_df(spark, [(t, f"S{t}") for t in range(4)])
    sc = spark.sparkContext
    sc.setJobGroup("building", "windows")
    try:
        built = [volatility_scan(df, dims, 20), volatility_scan(df, dims, 20, drop_first=True), ow.log_returns(df)]
        assert sc.statusTracker().getJobIdsForGroup("building") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    # One shuffle of the rows, reused for the edges, and one of the edges.
    for q in built[:2]:
        q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert plan.split("== Initial Plan ==")[0].count("ReusedExchange") + plan.count("ReusedExchange") >= 1


def test_empty_and_wrong_input(spark):
    assert ow.rolling_vol(spark.createDataFrame([], SCHEMA), 3).collect() == []
    with pytest.raises(ValueError):
        ow.rolling_vol(spark.createDataFrame([], SCHEMA), 0)
