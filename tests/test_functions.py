"""Scalar functions: time zones, vendor times, numbers, symbols."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barwise.functions import (clean_symbol, empty_to_null, int_or_null, local_date, local_label,
                               local_window, log_return, month_key, num_or, round_dec,
                               safe_div, symbol_forms, to_local, ts_lit, vendor_ts)
from barwise.operators.filters import regular_hours
from tests.conftest import bars_df


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_dst_both_sessions_open_at_0930(spark):
    # 14:30Z in January and 13:30Z in July are both 09:30 in New York.
    assert one(spark, to_local(ts_lit("2024-01-02 14:30:00"))) == dt.datetime(2024, 1, 2, 9, 30)
    assert one(spark, to_local(ts_lit("2024-07-02 13:30:00"))) == dt.datetime(2024, 7, 2, 9, 30)
    b = bars_df(spark, [(1, "2024-01-02 14:30", 1, 1, 1, 1, 1), (1, "2024-07-02 13:30", 1, 1, 1, 1, 1)])
    assert regular_hours(b).count() == 2


def test_session_edges_half_open(spark):
    # 09:30 and 15:55 local are kept, 16:00 is not.
    b = bars_df(spark, [(1, "2024-01-02 14:30", 1, 1, 1, 1, 1), (1, "2024-01-02 20:55", 1, 1, 1, 1, 1),
                        (1, "2024-01-02 21:00", 1, 1, 1, 1, 1), (1, "2024-01-02 14:25", 1, 1, 1, 1, 1)])
    kept = sorted(r.ts.strftime("%H:%M") for r in regular_hours(b).collect())
    assert kept == ["14:30", "20:55"]


def test_early_close_ignored(spark):
    # On 2024-07-03 (a half day) bars up to 15:55 local still count.
    b = bars_df(spark, [(1, "2024-07-03 17:05", 1, 1, 1, 1, 1), (1, "2024-07-03 19:55", 1, 1, 1, 1, 1)])
    assert regular_hours(b).count() == 2


def test_results_do_not_depend_on_session_time_zone(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, to_local(ts_lit("2024-07-02 13:30:00"))) == dt.datetime(2024, 7, 2, 9, 30)
        assert str(one(spark, local_date(ts_lit("2024-01-03 03:00:00")))) == "2024-01-02"
        assert one(spark, local_label(ts_lit("2024-03-10 07:30:00"))) == "2024-03-10 03:30"
        assert one(spark, month_key(ts_lit("2024-03-01 00:30:00"))) == "2024-03"
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_local_label_and_window(spark):
    assert one(spark, local_label(ts_lit("2024-01-02 14:30:00"))) == "2024-01-02 09:30"
    t0, t1 = local_window("2024-09-18", "09:30", "10:00")
    assert one(spark, t0) == dt.datetime(2024, 9, 18, 13, 30)
    assert one(spark, t1) == dt.datetime(2024, 9, 18, 14, 0)
    with pytest.raises(ValueError):
        local_window("2024-09-18", "10:00", "09:30")


def test_vendor_timestamps(spark):
    # epoch ns as number text and digit string, ISO with and without zone,
    # null and junk: four parse, two are dropped.
    rows = [("1704205800000000000",), ("1704205800000000000 ",), ("2024-01-02T14:30:00Z",),
            ("2024-01-02T09:30:00-05:00",), (None,), ("abc",)]
    df = spark.createDataFrame(rows, "t string").select(vendor_ts("t").alias("ts"))
    got = [r.ts for r in df.collect()]
    want = dt.datetime(2024, 1, 2, 14, 30)
    assert got[:4] == [want] * 4
    assert got[4:] == [None, None]


def test_numbers(spark):
    assert one(spark, int_or_null(F.lit(""))) is None
    assert one(spark, int_or_null(F.lit("x"))) is None
    assert one(spark, int_or_null(F.lit(" 320193 "))) == 320193
    assert one(spark, num_or(F.lit("bad"), 0, "bigint")) == 0
    # ROUND(1.005::numeric, 2) is 1.01.
    assert one(spark, round_dec(F.lit(1.005), 2)) == 1.01
    assert one(spark, round_dec(F.lit(-2.675), 2)) == -2.68
    # Division by zero and ln of a non-positive ratio are null (T4, T5).
    assert one(spark, safe_div(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, log_return(F.lit(0.0), F.lit(2.0))) is None
    assert one(spark, log_return(F.lit(2.0), F.lit(0.0))) is None


def test_symbols(spark):
    assert one(spark, clean_symbol(F.lit(" brk.b "))) == "BRK.B"
    assert one(spark, symbol_forms(F.lit("BRK.B"))) == ["BRK.B", "BRK-B", "BRK.B"]
    assert one(spark, symbol_forms(F.lit("BF-B"))) == ["BF-B", "BF-B", "BF.B"]
    assert one(spark, empty_to_null(F.lit("  "))) is None


def test_scale_settings():
    from barwise.session import scale_settings
    s = scale_settings(100 * 10**12)
    assert s["spark.sql.shuffle.partitions"] == "200000"
    assert scale_settings(10 << 20)["spark.sql.shuffle.partitions"] == "1"


def test_minute_of_day_any_epoch(spark):
    from barwise.functions.timefn import local_minute, minute_of_day
    assert one(spark, minute_of_day(ts_lit("1969-12-31 23:59:30"))) == 1439
    assert one(spark, minute_of_day(ts_lit("2024-01-02 14:30:59"))) == 870
    assert one(spark, local_minute(ts_lit("2024-07-02 13:30:00"))) == 570


def test_utc_window_of_regular_hours():
    from barwise.functions.timefn import utc_window, zone_offsets
    assert zone_offsets("America/New_York") == (-300, -240)
    assert utc_window("America/New_York", 570, 960) == (810, 1260)    # 13:30-21:00 UTC
    assert utc_window("UTC", 570, 960) == (570, 960)
    # 09:00-15:00 in Tokyo (which had summer time around 1950) wraps past
    # midnight UTC: 23:00-06:00.
    assert utc_window("Asia/Tokyo", 540, 900) == (1380, 360)
    assert utc_window("Australia/Sydney", 600, 960) == (1380, 360)


def test_regular_hours_in_a_wrapping_zone(spark):
    from barwise.operators.filters import regular_hours
    # 10:00 and 15:55 Sydney time are kept in January (UTC+11) and July (UTC+10).
    b = bars_df(spark, [(1, "2024-01-01 23:00", 1, 1, 1, 1, 1), (1, "2024-01-02 04:55", 1, 1, 1, 1, 1),
                        (1, "2024-07-02 00:00", 1, 1, 1, 1, 1), (1, "2024-07-02 06:00", 1, 1, 1, 1, 1),
                        (1, "2024-07-01 23:59", 1, 1, 1, 1, 1)])
    kept = sorted(str(r.ts) for r in regular_hours(b, "Australia/Sydney", "10:00", "16:00").collect())
    assert kept == ["2024-01-01 23:00:00", "2024-01-02 04:55:00", "2024-07-02 00:00:00"]


def test_session_date_shortcut():
    from barwise.functions.timefn import same_date_window
    assert same_date_window("America/New_York", 570, 960)
    assert not same_date_window("Asia/Tokyo", 540, 900)      # 09:00 JST is the prior UTC day
    assert not same_date_window("America/New_York", 0, 1440)


def test_clock_fields_ignore_the_session_zone_gap(spark):
    from barwise.functions.timefn import local_hhmm, minute_of_day
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 on 2024-03-10 does not exist in Los Angeles (spring forward);
        # a zone-free time must still read as 02:30.
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, minute_of_day(ts_lit("2024-03-10 02:30:00"))) == 150
        assert one(spark, local_hhmm(ts_lit("2024-07-02 13:30:00"))) == 930
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
