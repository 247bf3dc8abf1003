"""Staged, checked and published tables (K2, K3, M1-M3)."""

import os

import pytest
from pyspark.sql import functions as F

from barwise.plans import rollup as ru
from barwise.session import scratch_path
from barwise.sinks import layout as lay
from barwise.sinks.tables import PlainTable, StaleVersion, VersionedTable, open_table
from barwise.sources import read_constituents

from .conftest import bars_df, dims_df, ts

VENDOR = "symbol string, timestamp timestamp_ntz, open double, high double, low double, close double, volume bigint, vwap double, trade_count bigint"
ROWS = [(1, "2024-01-03 15:00", 1, 1, 1, 1, 10, 1.0, 1), (1, "2024-02-05 15:00", 2, 2, 2, 2, 10, 2.0, 1), (1, "2024-03-05 15:00", 3, 3, 3, 3, 10, 3.0, 1)]


def vendor(spark, *rows):
    return spark.createDataFrame([(s, ts(t), c, c, c, c, 10, c, 1) for s, t, c in rows], VENDOR)


def load(b, d, table, **kw):
    return lay.load_bars(b, d, table, "2023-01-01", "2025-01-01", **kw)


def days(df):
    return sorted((str(r.session_date), r.open) for r in df.collect())


KINDS = pytest.mark.parametrize("kind", [PlainTable, VersionedTable])


@KINDS
def test_a_refresh_lost_before_publishing_leaves_the_old_table(spark, monkeypatch, kind):
    table = kind(spark, scratch_path(spark, "lost"))
    ru.build_daily(bars_df(spark, ROWS), table)
    before = days(table.read())
    monkeypatch.setattr(kind, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("driver lost")))
    changed = bars_df(spark, [(*r[:2], 9, 9, 9, 9, *r[6:]) for r in ROWS[:2]])
    for again in (lambda: ru.refresh_daily(changed, table, ["2024-01", "2024-02"]), lambda: ru.build_daily(changed, table)):
        with pytest.raises(OSError):
            again()
        assert days(open_table(spark, table.path).read()) == before
    monkeypatch.undo()
    ru.refresh_daily(changed, table, ["2024-01", "2024-03"])
    assert days(table.read()) == [("2024-01-03", 9.0), ("2024-02-05", 2.0)]


def test_a_version_is_published_by_one_rename_and_old_readers_keep_theirs(spark, monkeypatch):
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    ru.build_daily(bars_df(spark, ROWS), table)
    old = table.read()
    moves = []
    move = type(table.files).move
    monkeypatch.setattr(type(table.files), "move", lambda self, a, b: (moves.append(b), move(self, a, b)))
    ru.build_daily(bars_df(spark, ROWS[1:]), table)
    assert len(moves) == 1 and moves[0].endswith("_versions/0000000002.json")
    assert len(days(old)) == 3 and len(days(table.read())) == 2 and len(days(table.read(1))) == 3
    assert table.version() == 2


def test_second_writer_from_the_same_version_is_refused(spark):
    table = VersionedTable(spark, scratch_path(spark, "race"))
    ru.build_daily(bars_df(spark, ROWS), table)
    base = table.version()
    rows = table.read()
    one, two = table.stage(rows.where("month = '2024-01'")), table.stage(rows.where("month = '2024-02'"))
    table.publish(one, "append", base=base)
    with pytest.raises(StaleVersion):
        table.publish(two, "append", base=base)
    assert table.version() == base + 1 and not [n for n in table.files.names(table.path + "/_versions") if "draft" in n]


def test_vacuum_keeps_what_the_last_versions_list(spark):
    table = VersionedTable(spark, scratch_path(spark, "vacuum"))
    for n in (3, 2, 1):
        ru.build_daily(bars_df(spark, ROWS[:n]), table)
    table.stage(table.read())  # a load that never was published
    gone = table.vacuum(keep=2)
    assert len(gone) == 2 and len(days(table.read())) == 1 and len(days(table.read(2))) == 2
    with pytest.raises(Exception):
        table.read(1).collect()


@KINDS
def test_modes(spark, kind):
    d, table = dims_df(spark, [(1, "AA")]), kind(spark, scratch_path(spark, "modes"))
    stored = lambda: sorted(str(r.ts) for r in table.read().collect())
    load(vendor(spark, ("AA", "2023-01-03 15:00", 1.0), ("AA", "2023-02-03 15:00", 1.0)), d, table)
    load(vendor(spark, ("AA", "2023-02-04 15:00", 1.0)), d, table)
    assert stored() == ["2023-01-03 15:00:00", "2023-02-04 15:00:00"]
    load(vendor(spark, ("AA", "2023-02-05 15:00", 1.0)), d, table, mode="append")
    assert len(stored()) == 3
    load(vendor(spark, ("AA", "2024-06-03 15:00", 1.0)), d, table, mode="truncate")
    assert stored() == ["2024-06-03 15:00:00"]
    with pytest.raises(ValueError):
        load(vendor(spark), d, table, mode="replace")


@KINDS
def test_refused_loads_leave_nothing_behind(spark, kind):
    d, table = dims_df(spark, [(1, "AA")]), kind(spark, scratch_path(spark, "refused"))
    load(vendor(spark, ("AA", "2023-01-03 15:00", 1.0)), d, table)
    twice = vendor(spark, ("AA", "2023-01-04 15:00", 1.0), ("AA", "2023-01-04 15:00", 2.0))
    bad = vendor(spark, ("AA", "2023-01-04 15:00", 1.0)).withColumn("low", F.lit(7.0))
    for rows, what in ((twice, "duplicate keys"), (bad, "rules")):
        with pytest.raises(ValueError, match=what):
            load(rows, d, table)
    assert table.read().count() == 1
    found = [f for _, _, fs in os.walk(table.path.replace("file:", "")) for f in fs if f.endswith(".parquet")]
    assert len(found) == 1


def test_input_is_scanned_once(spark):
    path = scratch_path(spark, "once")
    vendor(spark, ("AA", "2024-01-03 15:00", 1.0), ("AA", "2024-01-04 15:00", 1.0)).write.parquet(path)
    rows = spark.read.parquet(path)
    d = dims_df(spark, [(1, "AA")])
    out, _ = lay.checked_rows(rows, d, "2023-01-01", "2025-01-01")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "SortAggregate" not in plan
    # The range exchange samples what the hash exchange has written, not the input.
    assert plan.index("rangepartitioning") < plan.index("hashpartitioning") < plan.index("FileScan")
    report = {}
    load(rows, d, scratch_path(spark, "counted"), report=report)
    assert report == {"attempted": 2, "unknown_symbols": 0, "loaded": 2, "default_partition": 0, "duplicates": 0, "bad_rows": 0}


def test_one_key_in_most_rows_and_unknown_symbols(spark):
    d = dims_df(spark, [(1, "AA"), (2, "BB")])
    rows = [("AA", "2024-01-03 15:00", float(i % 7)) for i in range(500)] + [("BB", f"2024-01-03 15:{m:02d}", 1.0) for m in range(30)]
    rows += [("NO", "2024-01-03 15:00", 1.0)] * 20
    table, report = VersionedTable(spark, scratch_path(spark, "hot")), {}
    load(vendor(spark, *rows), d, table, on_duplicate="first", report=report)
    assert table.read().count() == 31 and table.read().where("ticker_id = 1").first().open == 0.0
    assert (report["duplicates"], report["unknown_symbols"], report["loaded"]) == (499, 20, 31)


def test_nothing_to_load(spark):
    d, table = dims_df(spark, [(1, "AA")]), VersionedTable(spark, scratch_path(spark, "nothing"))
    assert load(vendor(spark, ("NO", "2024-01-03 15:00", 1.0)), d, table).collect() == []
    assert table.read().count() == 0
    assert load(vendor(spark), d, scratch_path(spark, "none")).collect() == []


def test_months_are_pruned_in_a_versioned_table(spark):
    d, table = dims_df(spark, [(1, "AA")]), VersionedTable(spark, scratch_path(spark, "pruned"))
    load(vendor(spark, ("AA", "2023-01-03 15:00", 1.0), ("AA", "2023-02-03 15:00", 1.0)), d, table, by_day=True)
    load(vendor(spark, ("AA", "2023-03-03 15:00", 1.0)), d, table, by_day=True)
    from barwise.operators.filters import time_range
    got = time_range(table.read(), "2023-02-01 00:00:00", "2023-03-01 00:00:00")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "2023-02" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert [str(r.ts) for r in got.collect()] == ["2023-02-03 15:00:00"]
    assert len(got.inputFiles()) >= 1


def test_constituents_are_numbered_in_file_order(spark, tmp_path):
    for name, rows in (("a.csv", "ZZ,Old,S,I\nBB,B,S,I\n"), ("b.csv", "AA,A,S,I\nZZ,New,S,I\n")):
        (tmp_path / name).write_text("Symbol,Security,GICS Sector,GICS Sub-Industry\n" + rows)
    got = read_constituents(spark, f"file://{tmp_path}", numbered=True).orderBy("row_no").collect()
    assert [(r.row_no, r.Symbol, r.Security) for r in got] == [(1, "ZZ", "Old"), (2, "BB", "B"), (3, "AA", "A"), (4, "ZZ", "New")]
