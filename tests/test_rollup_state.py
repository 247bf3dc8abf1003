"""Mergeable rollup states, digest comparison, upserts of touched partitions (M3, M5, K8)."""

import random

import pytest
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.plans import rollup as ru
from barwise.plans import rollup_state as rs
from barwise.session import scratch_path
from barwise.sinks.merge import touched_parts, upsert, upsert_table
from barwise.sinks.tables import PlainTable, VersionedTable
from barwise.streaming import refresh

from .conftest import bars_df

SF = "/root/testdata/sf0.001"


def rows_of(daily):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in daily.select(*ru.DAILY_COLS).collect()), key=str)


def some_bars(seed, n=400):
    rng = random.Random(seed)
    seen = {(rng.randint(1, 3), f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d} {rng.randint(13, 21):02d}:{rng.randint(0, 11) * 5:02d}") for _ in range(n)}
    out = []
    for t, at in sorted(seen):
        o, c = rng.randint(10, 99), rng.randint(10, 99)
        out.append((t, at, o, max(o, c), min(o, c), c, rng.choice([0, 5, 100]), rng.choice([None, 10.5, 20.25]), rng.randint(0, 9)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_cut_merge_to_the_full_rollup(spark, seed):
    rows = some_bars(seed)
    rng = random.Random(seed)
    cut = [rng.randint(0, 3) for _ in rows]
    table = VersionedTable(spark, scratch_path(spark, "states"))
    for k in range(4):
        assert rs.apply_bars(table, bars_df(spark, [r for r, c in zip(rows, cut) if c == k]), k)
    assert rows_of(rs.finished(table.read())) == rows_of(ru.daily_rollup(bars_df(spark, rows)))


def test_a_batch_counts_once_and_only_its_months_are_rewritten(spark):
    table = VersionedTable(spark, scratch_path(spark, "states"))
    rows = some_bars(3)
    rs.apply_bars(table, bars_df(spark, rows[::2]), 0, "s")
    old = table.manifest()["folders"]
    late = bars_df(spark, [r for r in rows[1::2] if r[1].startswith("2024-02")])
    assert rs.apply_bars(table, late, 1, "s") and not rs.apply_bars(table, late, 1, "s") and not rs.apply_bars(table, late, 0, "s")
    new = table.manifest()["folders"]
    assert [m for m in new if new[m] != old[m]] == ["2024-02"] and table.version() == 2
    want = [r for i, r in enumerate(rows) if i % 2 == 0 or r[1].startswith("2024-02")]
    assert rows_of(rs.finished(table.read())) == rows_of(ru.daily_rollup(bars_df(spark, want)))
    assert rs.apply_bars(table, bars_df(spark, []), 0, "another")


def test_states_need_no_sort(spark):
    plan = rs.merge(rs.states(fx.bars_a(spark, SF)), rs.states(fx.bars_a(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_batch_lost_between_states_and_bars_is_made_up(spark, monkeypatch):
    rows = some_bars(4)
    fact, state = scratch_path(spark, "fact"), VersionedTable(spark, scratch_path(spark, "states"))
    go = lambda part, n: refresh.apply_batch_states(bars_df(spark, part), fact, state, "2023-01-01", "2025-01-01", n)
    go(rows[:200], 0)
    real = refresh.apply_bars

    def lost(*a, **k):
        real(*a, **k)
        raise OSError("driver lost")

    monkeypatch.setattr(refresh, "apply_bars", lost)
    with pytest.raises(OSError):
        go(rows[150:], 1)
    monkeypatch.undo()
    assert go(rows[150:], 1) is False
    assert spark.read.parquet(fact).count() == len(rows)
    assert rows_of(rs.finished(state.read())) == rows_of(ru.daily_rollup(bars_df(spark, rows)))


def test_digests_find_only_the_months_that_differ(spark):
    a = spark.createDataFrame([(m, i, float(i)) for m in ("2024-01", "2024-02", None) for i in range(30)], "month string, i int, x double")
    same = a.repartition(5).orderBy(F.col("i").desc())
    by = F.col("month")
    assert ru.differing(a, same, by).collect() == []
    assert tuple(ru.compare(a, same, by).first()) == (0, 0)
    one = a.withColumn("x", F.when(F.col("month").isNull() & (F.col("i") == 3), F.lit(-1.0)).otherwise(F.col("x")))
    assert [r[0] for r in ru.differing(a, one, by).collect()] == [None]
    twice = a.unionByName(a.where("month = '2024-02' and i = 1"))
    swapped = a.withColumn("month", F.when(F.col("i") == 5, F.when(by == "2024-01", "2024-02").otherwise("2024-01")).otherwise(by))
    gone = a.where("month = '2024-01'")
    for other in (one, twice, swapped, gone, a.where("false")):
        assert tuple(ru.compare(a, other, by).first()) == tuple(ru.compare(a, other).first()) != (0, 0)
    assert tuple(ru.compare(a.where("false"), a.where("false"), by).first()) == (0, 0)


ORDERS = "k long, v long, year string"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS)


@pytest.mark.parametrize("kind", [PlainTable, VersionedTable])
def test_upsert_rewrites_only_touched_partitions(spark, kind):
    table = kind(spark, scratch_path(spark, "upsert"), "year")
    first = [(i, i, str(2000 + i // 10)) for i in range(50)]
    upsert_table(table, orders(spark, first), ["k"])
    files = lambda: {f for f in table.read().inputFiles()}
    before = files()
    # 12 changes, 25 moves to 2004, 100 is new in 2009.
    batch = [(12, -1, "2001"), (25, -2, "2004"), (100, -3, "2009")]
    assert touched_parts(table, orders(spark, batch), ["k"]) == ["2001", "2002", "2004", "2009"]
    upsert_table(table, orders(spark, batch), ["k"])
    want = upsert(orders(spark, first), orders(spark, batch), ["k"]).select("k", "v", "year")
    assert sorted(map(tuple, table.read().select(F.col("k"), F.col("v"), F.col("year").cast("string")).collect())) == sorted(map(tuple, want.collect()))
    kept = {f for f in files() & before}
    assert {f.split("year=")[1][:4] for f in kept} == {"2000", "2003"}
    # All rows of 2009 move away: the partition goes.
    upsert_table(table, orders(spark, [(100, 0, "2000")]), ["k"])
    assert table.read().where("year = '2009'").count() == 0 and table.read().count() == 51
    with pytest.raises(ValueError):
        upsert_table(table, orders(spark, [(1, 0, "2000"), (1, 1, "2000")]), ["k"])


def test_upsert_of_named_columns_keeps_the_rest(spark):
    table = VersionedTable(spark, scratch_path(spark, "upsert"), "year")
    upsert_table(table, orders(spark, [(1, 1, "2000"), (2, 2, "2001")]), ["k"])
    upsert_table(table, orders(spark, [(1, 9, "2005"), (3, 3, "2001")]), ["k"], ["v"])
    assert sorted(map(tuple, table.read().collect())) == [(1, 9, "2000"), (2, 2, "2001"), (3, 3, "2001")]
