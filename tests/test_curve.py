"""Files clustered by instrument and time alike: fewer files for either kind of read."""

import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barwise import fixtures as fx
from barwise.functions.curve import BITS, curve_key
from barwise.plans import chart as ch
from barwise.plans import cross_section as cs
from barwise.registry_sql import SQL
from barwise.session import scratch_path
from barwise.sinks import layout as lay

SF = "/root/testdata/sf0.001"
KEYS = 64


def interleaved(key: int, seconds: int, keys: int) -> int:
    """The bits of both steps in turn, bit by bit."""
    a = min(max(key, 0), keys) * (1 << BITS) // (keys + 1)
    b = seconds * (1 << BITS) // (31 * 86400)
    return sum((a >> i & 1) << (2 * i) | (b >> i & 1) << (2 * i + 1) for i in range(BITS))


def test_curve_key_interleaves_bits(spark):
    rows = [(k, s) for k in (-3, 0, 1, 7, 40, 63, 64, 900) for s in (0, 1, 59, 86399, 86400, 1_500_000, 31 * 86400 - 1)]
    df = spark.createDataFrame(rows, "k int, s long")
    ts = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")
    got = {(r.k, r.s): r.z for r in df.select("k", "s", curve_key(F.col("k"), ts, KEYS).alias("z")).collect()}
    assert got == {(k, s): interleaved(k, s, KEYS) for k, s in rows}


def test_curve_key_of_nulls(spark):
    df = spark.sql("SELECT CAST(NULL AS INT) AS k, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t UNION ALL SELECT 3, NULL")
    rows = [r.z for r in df.select(curve_key(F.col("k"), F.col("t"), KEYS).alias("z")).collect()]
    assert sorted(rows) == [0, interleaved(3, 0, KEYS)]
    assert lay.cluster(df.withColumn("month", F.lit("m")), key="k", ts="t", curve_keys=KEYS).count() == len(rows) == 2


def touched(path: str, column: str, value) -> int:
    """Row groups whose least and largest value of the column leave room for the value."""
    n = 0
    for f in glob.glob(os.path.join(path, "month=*", "*.parquet")):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().get_field_index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            n += s.min <= value <= s.max
    return n


@pytest.fixture(scope="module")
def layouts(spark):
    hours = spark.range(KEYS * 31 * 24).select(
        (F.col("id") % KEYS + 1).cast("int").alias("ticker_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, CAST(id DIV 64 AS INT))").alias("ts"),
        F.lit("2024-01").alias("month"))
    hours = hours.withColumn("place", F.unix_seconds(F.col("ts").cast("timestamp")))
    paths = scratch_path(spark, "plain"), scratch_path(spark, "curve")
    for path, keys in zip(paths, (None, KEYS)):
        lay.write_partitioned(lay.cluster(hours, partitions=64, curve_keys=keys), path)
    return paths


def test_both_kinds_of_read_touch_few_row_groups(spark, layouts):
    plain, curve = layouts
    noon = spark.read.parquet(curve).where("ts = TIMESTAMP_NTZ '2024-01-17 12:00:00'").first()["place"]
    files = len(glob.glob(os.path.join(curve, "month=*", "*.parquet")))
    assert files >= 48
    # In the plain order one instrument is in one or two files and one time in all of them.
    assert touched(plain, "place", noon) >= 48
    assert touched(curve, "place", noon) <= 16
    assert touched(curve, "ticker_id", 17) <= 16
    worse = touched(plain, "place", noon) + touched(plain, "ticker_id", 17)
    assert touched(curve, "place", noon) + touched(curve, "ticker_id", 17) < worse / 2


def test_curve_keeps_every_row_and_column(spark, layouts):
    a, b = (spark.read.parquet(p) for p in layouts)
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_load_along_the_curve_answers_alike(spark):
    vendor, dims = fx.vendor_rows_a(spark, SF), fx.instruments_a(spark, SF)
    m, z = scratch_path(spark, "m"), scratch_path(spark, "z")
    lay.load_bars(vendor, dims, m, "2023-01-01", "2025-01-01")
    lay.load_bars(vendor, dims, z, "2023-01-01", "2025-01-01", curve=True)
    plain, curve = spark.read.parquet(m), spark.read.parquet(z)
    assert plain.columns == curve.columns
    for q in (lambda t: cs.cross_section(t, dims, "2024-01-16 19:55:00"),
              lambda t: ch.ticker_chart(t, dims, "NATION_7", "2024-01-08 00:00:00", "2024-01-15 00:00:00")):
        assert [tuple(r) for r in q(plain).collect()] == [tuple(r) for r in q(curve).collect()]
    again = lay.load_bars(vendor, dims, z, "2023-01-01", "2025-01-01", mode="append", on_duplicate="first", curve=True)
    assert again.agg(F.sum("rows")).first()[0] == plain.count()
    assert {"cross_section_curve_layout", "ticker_chart_curve_layout"} <= set(SQL)


def test_load_along_the_curve_of_no_instruments(spark):
    vendor, dims = fx.vendor_rows_a(spark, SF), fx.instruments_a(spark, SF).limit(0)
    assert lay.load_bars(vendor, dims, scratch_path(spark, "none"), "2023-01-01", "2025-01-01", curve=True).isEmpty()
