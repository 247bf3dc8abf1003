"""Operators on micro fixtures (FIXTURES.md section 4)."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwise.operators.bars import bars_from_ticks
from barwise.operators.filters import clip_range, drop_blank_symbols, time_range
from barwise.operators.joins import resolve_ids, symbols_without_bars
from barwise.operators.quality import check_bars, duplicate_keys, key_report
from barwise.operators.refdata import (assign_ids, resolve_symbols, symbol_variants,
                                       tag_exchange)
from barwise.operators.windows import rolling_vol
from barwise.plans.cross_section import cross_section
from barwise.plans.movers import top_movers
from barwise.plans.rollup import daily_rollup
from barwise.sinks.layout import assign_month
from barwise.sinks.merge import insert_ignore, load_report, upsert
from tests.conftest import bars_df, dims_df, ts


def test_bars_from_ticks_first_last_and_zero_volume(spark):
    rows = [(1, ts("2024-01-02 14:31:00"), 2, 10.0, 5), (1, ts("2024-01-02 14:31:00"), 1, 11.0, 5),
            (1, ts("2024-01-02 14:34:59"), 3, 9.0, 10), (2, ts("2024-01-02 14:35:00"), 4, 7.0, 0)]
    t = spark.createDataFrame(rows, "ticker_id int, ts timestamp_ntz, event_id long, price double, size long")
    b = {r.ticker_id: r for r in bars_from_ticks(t, order=("ts", "event_id")).collect()}
    assert b[1].ts == dt.datetime(2024, 1, 2, 14, 30)
    assert (b[1].open, b[1].high, b[1].low, b[1].close) == (11.0, 11.0, 9.0, 9.0)
    assert b[1].volume == 20 and b[1].trade_count == 3
    assert b[1].vwap == pytest.approx((10 * 5 + 11 * 5 + 9 * 10) / 20)
    assert b[2].vwap is None  # zero volume: no division error


def test_daily_rollup_vwap_rules(spark):
    # Zero-volume day -> null vwap; a bar with null vwap leaves the numerator
    # but keeps its volume in the denominator.
    b = bars_df(spark, [(1, "2024-01-02 14:30", 10, 12, 9, 11, 0, 10.0, 1),
                        (1, "2024-01-02 14:35", 11, 13, 10, 12, 0, 11.0, 1),
                        (2, "2024-01-02 14:30", 10, 12, 9, 11, 100, 10.0, 5),
                        (2, "2024-01-02 14:35", 11, 13, 10, 12, 100, None, 6)])
    d = {r.ticker_id: r for r in daily_rollup(b).collect()}
    assert d[1].vwap is None and d[1].volume == 0
    assert d[2].vwap == pytest.approx(1000.0 / 200)
    assert (d[2].open, d[2].high, d[2].low, d[2].close, d[2].trade_count) == (10, 13, 9, 12, 11)
    assert str(d[2].session_date) == "2024-01-02"


def test_check_bars_quarantine(spark):
    b = bars_df(spark, [(1, "2024-01-02 14:30", 10, 9, 8, 10, 5),   # high < open, close
                        (1, "2024-01-02 14:35", 10, 11, 9, 10, -1),  # volume < 0
                        (1, "2024-01-02 14:40", 10, 11, 9, 10, 1)])
    good, bad = check_bars(b)
    assert good.count() == 1
    tags = sorted(tuple(r.violations) for r in bad.collect())
    assert tags == [("high_ge_open", "high_ge_close"), ("volume_nonneg",)]
    assert good.count() + bad.count() == b.count()


def test_resolve_ids_unknown_dropped_and_counted(spark):
    vendor = spark.createDataFrame([("AAPL", 1), ("ZZZZ", 2), ("AAPL", 3)], "symbol string, x int")
    dims = dims_df(spark, [(7, "AAPL")])
    kept, unknown = resolve_ids(vendor, dims)
    assert kept.count() == 2 and unknown.count() == 1
    added, _ = resolve_ids(vendor, dims, on_unknown="add")
    assert added.count() == 3


def test_out_of_range_and_default_partition(spark):
    b = bars_df(spark, [(1, "2022-12-31 15:00", 1, 1, 1, 1, 1), (1, "2023-06-01 15:00", 1, 1, 1, 1, 1),
                        (1, "2025-01-01 00:00", 1, 1, 1, 1, 1)])
    months = sorted(r.month for r in assign_month(b, "2023-01-01", "2025-01-01").collect())
    assert months == ["2023-06", "default", "default"]
    kept, dropped = clip_range(b, "2023-01-01 00:00:00", "2025-01-01 00:00:00")
    assert (kept.count(), dropped.count()) == (1, 2)


def test_blank_symbols_skipped(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("A",)], "symbol string")
    assert [r.symbol for r in drop_blank_symbols(df).collect()] == ["A"]


def test_duplicate_key_rules(spark):
    b = bars_df(spark, [(1, "2024-01-02 14:30", 1, 1, 1, 1, 1), (1, "2024-01-02 14:30", 2, 2, 2, 2, 2),
                        (1, "2024-01-02 14:35", 1, 1, 1, 1, 1)])
    assert duplicate_keys(b, ["ticker_id", "ts"]).count() == 1
    r = key_report(b, ["ticker_id", "ts"]).first()
    assert (r.rows, r.distinct_keys, r.duplicated_keys) == (3, 2, 1)


def test_insert_ignore_first_kept_and_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x", 1), (3, "y", 2), (3, "z", 1)], "k int, v string, o int")
    out = insert_ignore(target, batch.select("k", "v", "o"), ["k"], order=["o"]).select("k", "v")
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b"), (3, "z")]
    again = insert_ignore(out, batch.select("k", "v"), ["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    rep = load_report(target, batch, ["k"]).first()
    assert (rep.attempted, rep.inserted, rep.matched) == (3, 2, 1)


def test_upsert_replaces_including_nulls_and_rejects_duplicates(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    batch = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "k int, v string, w int")
    out = {r.k: (r.v, r.w) for r in upsert(target, batch, ["k"]).collect()}
    assert out == {1: ("a", 10), 2: (None, 21), 3: ("c", 30)}
    only_w = {r.k: (r.v, r.w) for r in upsert(target, batch, ["k"], cols=["w"]).collect()}
    assert only_w[2] == ("b", 21)
    dup = spark.createDataFrame([(3, "c", 1), (3, "d", 2)], "k int, v string, w int")
    with pytest.raises(ValueError):
        upsert(target, dup, ["k"])


def _naive_vol(bars, n, drop_first):
    w = Window.partitionBy("ticker_id").orderBy("ts")
    r = bars.withColumn("logret", F.when(F.col("close") / F.lag("close").over(w) > 0,
                                         F.ln(F.col("close") / F.lag("close").over(w))))
    if drop_first:
        r = r.where(F.col("logret").isNotNull())
    return r.withColumn("rv", F.sqrt(F.sum(F.col("logret") ** 2).over(w.rowsBetween(-(n - 1), 0))))


@pytest.mark.parametrize("drop_first", [False, True])
def test_blocked_volatility_equals_plain_window(spark, drop_first):
    # A hot instrument with many months, a sparse one, and gaps: tiny blocks
    # force many block boundaries and halos spanning several months.
    rnd = random.Random(7)
    rows, t = [], dt.datetime(2023, 1, 2, 15, 0)
    for i in range(900):
        t += dt.timedelta(days=rnd.choice([1, 1, 2, 9, 33]))
        rows.append((1, t.strftime("%Y-%m-%d %H:%M"), 1, 1, 1, 10 + rnd.random(), 1))
        if i % 37 == 0:
            rows.append((2, t.strftime("%Y-%m-%d %H:%M"), 1, 1, 1, 5 + rnd.random(), 1))
    b = bars_df(spark, rows)
    got = {(r.ticker_id, r.ts): r.rv for r in rolling_vol(b, 20, drop_first, block_rows=5).collect()}
    want = {(r.ticker_id, r.ts): r.rv for r in _naive_vol(b, 20, drop_first).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert (got[k] is None and v is None) or got[k] == pytest.approx(v, rel=1e-12)


def test_first_bar_null_and_partial_frames(spark):
    b = bars_df(spark, [(1, f"2024-01-0{d} 15:00", 1, 1, 1, c, 1) for d, c in
                        [(2, 10.0), (3, 11.0), (4, 12.1)]])
    full = {r.ts.day: r.rv for r in rolling_vol(b, 20).collect()}
    assert full[2] is None and full[3] is not None  # T10, T11
    app = {r.ts.day for r in rolling_vol(b, 20, drop_first=True).collect()}
    assert app == {3, 4}


def test_cross_section_monday_has_no_prior(spark):
    # Friday 2024-06-28 and Monday 2024-07-01: the prior is exactly one day
    # earlier (Sunday), so Monday's prior close is null and sorts last.
    b = bars_df(spark, [(1, "2024-06-28 19:55", 1, 1, 1, 100, 1), (1, "2024-07-01 19:55", 1, 1, 1, 110, 1),
                        (2, "2024-06-30 19:55", 1, 1, 1, 50, 1), (2, "2024-07-01 19:55", 1, 1, 1, 40, 1),
                        (3, "2024-06-30 19:55", 1, 1, 1, 50, 1), (3, "2024-07-01 19:55", 1, 1, 1, 60, 1)])
    dims = dims_df(spark, [(1, "A"), (2, "B"), (3, "C")])
    rows = cross_section(b, dims, "2024-07-01 19:55:00").collect()
    assert [r.symbol for r in rows] == ["C", "B", "A"]
    assert rows[-1].prev_close is None and rows[-1].ret_1d is None


def test_top_movers_ties_and_nulls(spark):
    b = bars_df(spark, [(1, "2024-09-18 13:30", 10, 1, 1, 11, 1), (2, "2024-09-18 13:30", 20, 1, 1, 22, 1),
                        (3, "2024-09-18 13:30", 0.0, 1, 1, 5, 1), (4, "2024-09-18 13:35", 10, 1, 1, 9, 1)])
    dims = dims_df(spark, [(1, "B"), (2, "A"), (3, "Z"), (4, "C")])
    out = top_movers(b, dims, "2024-09-18 13:30:00", "2024-09-18 14:00:00", 2).collect()
    assert [r.symbol for r in out] == ["A", "B"]  # equal returns, symbol breaks the tie
    assert out[0].ret_pct == 10.0


def test_symbols_without_bars(spark):
    dims = dims_df(spark, [(1, "A"), (2, "B")])
    b = bars_df(spark, [(1, "2024-01-02 14:30", 1, 1, 1, 1, 1)])
    assert [r.symbol for r in symbols_without_bars(dims, b).collect()] == ["B"]


def test_resolve_symbols_rules(spark):
    const = spark.createDataFrame(
        [(1, "BRK.B"), (2, "brk-b"), (3, "AAPL"), (4, " "), (5, "NOPE"), (6, "BF.B"), (7, "MSFT")],
        "row_no int, Symbol string")
    tradable = spark.createDataFrame([("BRK-B",), ("AAPL",), ("BF.B",), ("MSFT",)], "symbol string")
    resolved, counts = resolve_symbols(const, tradable, max_symbols=3)
    assert [(r.row_no, r.pick) for r in resolved.orderBy("row_no").collect()] == \
        [(1, "BRK-B"), (3, "AAPL"), (6, "BF.B")]
    c = counts.first()
    # rows 2 (duplicate) and 5 (not tradable) are skipped; blanks are not
    # counted; row 7 comes after the cut-off.
    assert (c.resolved, c.skipped) == (3, 2)


def test_symbol_variants_last_row_wins(spark):
    const = spark.createDataFrame([(1, "BRK.B", "Berkshire", "Fin"), (2, "BRK-B", "Berk2", "Fin2")],
                                  "row_no int, Symbol string, Security string, `GICS Sector` string")
    v = {r.symbol: (r.name, r.sector) for r in symbol_variants(const).collect()}
    assert v == {"BRK.B": ("Berk2", "Fin2"), "BRK-B": ("Berk2", "Fin2")}


def test_assign_ids_stable(spark):
    first = assign_ids(spark.createDataFrame([("b",), ("a",)], "name string"), None, "sid")
    assert sorted(map(tuple, first.collect())) == [(1, "a"), (2, "b")]
    again = assign_ids(spark.createDataFrame([("c",), ("a",), ("0",)], "name string"), first, "sid")
    assert sorted(map(tuple, again.collect())) == [(1, "a"), (2, "b"), (3, "0"), (4, "c")]


def test_tag_exchange_list_and_table(spark):
    df = spark.createDataFrame([("AAPL",), ("JPM",)], "symbol string")
    assert {r.symbol: r.exchange_code for r in tag_exchange(df).collect()} == \
        {"AAPL": "XNAS", "JPM": "XNYS"}
    lst = spark.createDataFrame([("JPM",)], "s string")
    assert {r.symbol: r.exchange_code for r in tag_exchange(df, lst).collect()} == \
        {"AAPL": "XNYS", "JPM": "XNAS"}


def test_time_range_half_open(spark):
    b = bars_df(spark, [(1, "2024-03-01 00:00", 1, 1, 1, 1, 1), (1, "2024-04-01 00:00", 1, 1, 1, 1, 1)])
    assert time_range(b, "2024-03-01 00:00:00", "2024-04-01 00:00:00").count() == 1


def test_refresh_tickers_upserts_by_symbol(spark):
    from barwise.operators.refdata import (build_industries, build_sectors, build_tickers,
                                           refresh_tickers)
    from barwise.sources.seed import exchanges
    cols = "Symbol string, Security string, `GICS Sector` string, `GICS Sub-Industry` string, " \
           "`Headquarters Location` string, `Date added` string, CIK string"
    c1 = spark.createDataFrame([("AAPL", "Apple", "IT", "Hardware", "Cupertino", "1982-11-30", "320193"),
                                ("JPM", "JPMorgan", "Fin", "Banks", "", "", "x")], cols)
    sec = build_sectors(c1)
    ind = build_industries(c1, sec)
    t1 = build_tickers(c1, sec, ind, exchanges(spark))
    r = {x.symbol: x for x in t1.collect()}
    assert r["AAPL"].exchange_id == 2 and r["JPM"].exchange_id == 1
    assert r["JPM"].cik is None and r["JPM"].headquarters is None and r["JPM"].date_added is None
    c2 = spark.createDataFrame([("JPM", "JPMorgan Chase", "Fin", "Banks", "New York", "", "19617"),
                                ("MSFT", "Microsoft", "IT", "Hardware", "Redmond", "", "789019")], cols)
    sec2 = build_sectors(c2, sec)
    ind2 = build_industries(c2, sec2, ind)
    t2 = {x.symbol: x for x in refresh_tickers(t1, c2, sec2, ind2, exchanges(spark)).collect()}
    assert set(t2) == {"AAPL", "JPM", "MSFT"}
    assert t2["JPM"].ticker_id == r["JPM"].ticker_id and t2["JPM"].name == "JPMorgan Chase"
    assert t2["JPM"].cik == 19617 and t2["AAPL"].name == "Apple"
    assert t2["MSFT"].ticker_id == 3 and t2["MSFT"].exchange_id == 2


def test_calendar_rows_and_upsert(spark):
    from barwise.operators.refdata import refresh_calendar, sessions_from_bars
    from barwise.sources.seed import exchanges
    b = bars_df(spark, [(1, "2024-07-03 13:30", 1, 1, 1, 1, 1), (1, "2024-07-03 16:55", 1, 1, 1, 1, 1),
                        (1, "2024-07-05 13:30", 1, 1, 1, 1, 1), (1, "2024-07-05 19:55", 1, 1, 1, 1, 1)])
    s = sessions_from_bars(b)
    cal = refresh_calendar(None, s, exchanges(spark))
    rows = {(r.exchange_id, str(r.session_date)): r for r in cal.collect()}
    assert len(rows) == 4
    assert rows[(1, "2024-07-03")].is_early_close and not rows[(2, "2024-07-05")].is_early_close
    again = refresh_calendar(cal, s, exchanges(spark))
    assert again.count() == 4


def test_daily_rollup_in_a_zone_east_of_utc(spark):
    # 00:30Z on 2024-01-02 is 09:30 in Tokyo on 2024-01-02; 05:55Z is 14:55.
    # The local date differs from the UTC date for the 23:30Z bar (08:30 local,
    # outside the session) and must come from the converted clock.
    b = bars_df(spark, [(1, "2024-01-01 23:30", 5, 5, 5, 5, 1), (1, "2024-01-02 00:30", 10, 11, 9, 10, 2),
                        (1, "2024-01-02 05:55", 10, 12, 8, 11, 3), (1, "2024-01-03 00:00", 7, 7, 7, 7, 4)])
    d = [(str(r.session_date), r.open, r.close, r.volume)
         for r in daily_rollup(b, "Asia/Tokyo", "09:00", "15:00").orderBy("session_date").collect()]
    assert d == [("2024-01-02", 10.0, 11.0, 5), ("2024-01-03", 7.0, 7.0, 4)]


def test_grain_weekdays_and_bounds(spark):
    from barwise.operators.filters import choose_grain, loaded_bounds, weekdays_only
    assert choose_grain("2024-03-01", "2024-03-06") == "raw"      # 5 days
    assert choose_grain("2024-03-01", "2024-03-07") == "daily"    # 6 days
    assert choose_grain("2024-03-01", "2024-03-07", "raw") == "raw"
    with pytest.raises(ValueError):
        choose_grain("2024-03-07", "2024-03-01")
    days = spark.createDataFrame([(dt.date(2024, 6, d),) for d in range(28, 31)] +
                                 [(dt.date(2024, 7, 1),)], "session_date date")
    assert [r.session_date.day for r in weekdays_only(days).orderBy("session_date").collect()] \
        == [28, 1]
    lo, hi = loaded_bounds(F.lit("2022-05-01").cast("date"), F.lit("2026-01-01").cast("date"),
                           F.lit("2023-01-01").cast("date"), F.lit("2024-12-31").cast("date"))
    r = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    assert (str(r.lo), str(r.hi)) == ("2023-01-01", "2024-12-31")


def test_first_open_keeps_null_like_array_agg(spark):
    # The open of the first bar wins even when it is null.
    rows = [(1, dt.datetime(2024, 1, 2, 14, 30), None, 2.0, 1.0, 1.5, 10, 1.0, 1),
            (1, dt.datetime(2024, 1, 2, 14, 35), 1.2, 2.0, 1.0, 1.7, 10, 1.0, 1)]
    b = spark.createDataFrame(rows, "ticker_id int, ts timestamp_ntz, open double, high double, "
                              "low double, close double, volume long, vwap double, "
                              "trade_count long")
    r = daily_rollup(b).first()
    assert r.open is None and r.close == 1.7


def test_cross_section_at_a_new_york_time(spark):
    from barwise.functions.timefn import local_instant
    # 15:55 in New York on 2024-06-28 (EDT) is 19:55 UTC.
    b = bars_df(spark, [(1, "2024-06-27 19:55", 1, 1, 1, 100, 1), (1, "2024-06-28 19:55", 1, 1, 1, 110, 1)])
    dims = dims_df(spark, [(1, "A")])
    r = cross_section(b, dims, local_instant("2024-06-28", "15:55")).first()
    assert (r.close, r.prev_close) == (110.0, 100.0) and abs(r.ret_1d - 0.1) < 1e-12
