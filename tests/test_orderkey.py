"""Fixed-width order keys and the aggregates built on them."""

import random

import pytest
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.functions.orderkey import Part, packed, parts_of
from barwise.operators.bars import bars_from_ticks
from barwise.sinks.merge import first_per_key

from .conftest import ts

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def in_order(rows, value, place):
    """Rows sorted by ``value`` are sorted by ``place``; equal ones have equal places."""
    rows = sorted(rows, key=value)
    return all(place(a) <= place(b) and (value(a) != value(b)) >= (place(a) != place(b)) for a, b in zip(rows, rows[1:]))


def test_keys_order_like_their_columns(spark):
    rng = random.Random(5)
    longs = [None, 0, 1, -1, 2**63 - 1, -2**63] + [rng.randint(-9, 9) for _ in range(20)]
    times = [None, ts("0001-01-01 00:00:00"), ts("9999-12-31 23:59:59.999999"), ts("1969-12-31 23:59:59.999999"), ts("1970-01-01")]
    rows = [(rng.choice(times), rng.choice(longs)) for _ in range(400)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, id long")
    got = df.select("t", "id", packed(df.schema, ["t", "id"]).alias("k")).collect()
    assert in_order(got, lambda r: (r.t is not None, r.t or ts("1970-01-01"), r.id is not None, r.id or 0), lambda r: r.k)


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_zone_free_times_keep_their_order_over_a_clock_change(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(ts(f"2024-11-03 {h:02d}:{m:02d}:00.00000{h}"), 0) for h in range(4) for m in (0, 30)], "t timestamp_ntz, id int")
        got = [r.k for r in df.select("t", packed(df.schema, ["t", "id"]).alias("k")).orderBy("t").collect()]
        assert got == sorted(set(got))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_prices_order_at_their_resolution(spark):
    xs = [None, float("-inf"), -1e300, -2.5, -1e-9, 0.0, 0.25, 0.5, 1e12, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "x double, i long")
    got = [r.k for r in df.select("i", packed(df.schema, ["x", Part("i", 8)]).alias("k")).orderBy("i").collect()]
    assert got == sorted(set(got))
    two = packed(df.schema, [Part("x", 10, 4)])
    assert [int(r.k) for r in df.filter("i in (3, 5, 6, 7, 8)").select("i", two.alias("k")).orderBy("i").collect()] == [503, 513, 514, 515, 1024]


def test_declared_bits_are_checked(spark):
    df = spark.createDataFrame([(1, 300)], "a long, b long")
    with pytest.raises(Exception, match="does not fit 8 bits"):
        df.select(packed(df.schema, [Part("a", 8), Part("b", 8)])).collect()
    assert parts_of(df.schema, ["a", "b"]) is None
    with pytest.raises(ValueError, match="narrower"):
        packed(df.schema, ["a", "b"])


def test_bars_and_first_rows_are_hash_aggregates(spark):
    a, b = fx.bars_a(spark, SF), fx.bars_b(spark, SF)
    first = first_per_key(b.unionByName(b), ["ticker_id", "ts"], ["open", "high"])
    for df in (a, b, first):
        assert "HashAggregate" in plan(df) and "SortAggregate" not in plan(df)


def test_bars_with_ties_in_time(spark):
    rng = random.Random(2)
    rows = [(rng.randint(1, 3), ts(f"2024-01-02 15:0{rng.randint(0, 9)}:00"), i, float(rng.randint(1, 99)), 10) for i in range(500)]
    df = spark.createDataFrame(rows, "ticker_id int, ts timestamp_ntz, event_id long, price double, size long").repartition(7)
    got = {(r.ticker_id, r.ts): (r.open, r.close) for r in bars_from_ticks(df, order=("ts", "event_id")).collect()}
    want = {}
    for t, at, i, p, _ in rows:
        want.setdefault((t, at.replace(minute=at.minute // 5 * 5)), []).append((at, i, p))
    assert got == {k: (min(v)[2], max(v)[2]) for k, v in want.items()}


def test_first_per_key_keeps_one_whole_row(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 20), float(rng.randint(0, 3)), rng.randint(0, 1000), rng.choice([True, False, None])) for _ in range(600)]
    rows += [(None, None, None, None), (None, 1.0, 1, True)] + [(99, 1.0, 5, True)] * 50
    schema = "k long, open double, v long, flag boolean"
    one = first_per_key(spark.createDataFrame(rows, schema).repartition(1), ["k"], ["open"])
    two = first_per_key(spark.createDataFrame(rows, schema).repartition(9), ["k"], ["open"])
    a, b = (sorted(map(tuple, d.collect()), key=str) for d in (one, two))
    assert a == b and set(a) <= set(rows) and len(a) == len({r[0] for r in rows})
    for k, open_, *_ in a:
        assert open_ == min((r[1] for r in rows if r[0] == k), key=lambda x: (x is not None, x))


def test_first_per_key_with_text_and_without_order(spark):
    rows = [(1, "b", 2), (1, "a", 3), (2, "c", 1)]
    df = spark.createDataFrame(rows, "k long, name string, n long")
    assert sorted(map(tuple, first_per_key(df, ["k"], ["n"]).collect())) == [(1, "b", 2), (2, "c", 1)]
    assert sorted(map(tuple, first_per_key(df, ["k"]).collect())) == [(1, "a", 3), (2, "c", 1)]
    assert first_per_key(df.select("k"), ["k"]).count() == 2
    assert first_per_key(df.filter("k = 5").drop("name"), ["k"], ["n"]).collect() == []
    assert df.withColumn("_x", F.lit(1)).transform(lambda d: first_per_key(d, ["k"], ["n"])).columns == ["k", "name", "n", "_x"]
