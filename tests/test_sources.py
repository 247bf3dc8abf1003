"""Sources: CSV, vendor JSON pages, yearly files, required columns, profile."""

import datetime as dt
import json
import os

import pytest

from barwise.session import scratch_path
from barwise.sinks.layout import write_yearly
from barwise.sources import (normalise_pages, profile_input, read_bars, read_constituents,
                             require_columns)
from barwise.sources.vendor import pack_pages


def test_constituents_csv_all_strings(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(path)
    with open(os.path.join(path, "c.csv"), "w") as f:
        f.write("Symbol,Security,GICS Sector,GICS Sub-Industry,Headquarters Location,"
                "Date added,CIK,Founded\n")
        f.write("BRK.B,Berkshire Hathaway,Financials,Multi-Sector Holdings,\"Omaha, Nebraska\","
                "2010-02-16,0001067983,1839\n")
        f.write("MMM,3M,Industrials,Industrial Conglomerates,,1957-03-04,,1902\n")
    df = read_constituents(spark, path)
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    rows = {r.Symbol: r for r in df.collect()}
    assert rows["BRK.B"]["CIK"] == "0001067983"
    assert rows["BRK.B"]["Headquarters Location"] == "Omaha, Nebraska"


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "symbol int")
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(df, ["symbol", "timestamp"])


def test_vendor_pages_normalised(spark):
    page = {"bars": {"AAPL": [
        {"t": 1704205800000000000, "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 100, "vw": 1.2,
         "n": 7},
        {"t": "2024-01-02T14:35:00Z", "o": "x", "h": 2, "l": 1, "c": 1, "v": None, "n": 3},
        {"t": "abc", "o": 1, "h": 1, "l": 1, "c": 1, "v": 1, "vw": 1, "n": 1},
        {"o": 1}], "MSFT": []}, "next_page_token": None}
    pages = spark.createDataFrame([(json.dumps(page),)], "page string")
    rows = sorted(normalise_pages(pages).collect(), key=lambda r: r.timestamp)
    assert len(rows) == 2
    assert rows[0].timestamp == dt.datetime(2024, 1, 2, 14, 30)
    assert (rows[0].volume, rows[0].vwap, rows[0].trade_count) == (100, 1.2, 7)
    assert rows[1].open is None and rows[1].volume == 0 and rows[1].vwap == 0.0  # T13
    keep_null = normalise_pages(pages, missing_vwap=None).collect()
    assert sorted([r.vwap for r in keep_null], key=str) == [1.2, None]


def test_pages_round_trip(spark):
    rows = [("AAPL", dt.datetime(2024, 1, 2, 14, 30), 1.0, 2.0, 0.5, 1.5, 10, 1.25, 3, "p1"),
            ("MSFT", dt.datetime(2024, 1, 2, 14, 30), 3.0, 4.0, 2.5, 3.5, 20, 3.3, 4, "p1")]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, "
                               "high double, low double, close double, volume long, vwap double, "
                               "trade_count long, page_no string")
    back = normalise_pages(pack_pages(df)).collect()
    assert sorted(tuple(r) for r in back) == sorted(tuple(r)[:9] for r in rows)


def test_yearly_files_and_glob(spark):
    rows = [("AAPL", dt.datetime(2023, 12, 29, 20, 55), 1.0, 1.0, 1.0, 1.0, 1, 1.0, 1),
            ("AAPL", dt.datetime(2024, 1, 2, 14, 30), 2.0, 2.0, 2.0, 2.0, 2, 2.0, 2)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, open double, "
                               "high double, low double, close double, volume long, vwap double, "
                               "trade_count long")
    path = scratch_path(spark, "yearly")
    write_yearly(df, path)
    assert [d for d in sorted(os.listdir(path)) if d.startswith("year=")] == ["year=2023", "year=2024"]
    # Rewriting 2024 replaces that year only.
    write_yearly(df.where("year(timestamp) = 2024"), path)
    assert read_bars(spark, [path], glob="*.parquet").count() == 2
    per_file, sample = profile_input(read_bars(spark, [path]))
    assert per_file.count() == 2 and sample.count() == 2
    assert {r.row_index for r in sample.collect()} == {0}
    with pytest.raises(ValueError):
        read_bars(spark, [])
    with pytest.raises(ValueError, match="no files matching"):
        read_bars(spark, [path], glob="*.csv")


def test_vendor_file_time_encodings(spark):
    """The vendor loader's timestamp[ns, UTC], a UTC-adjusted microsecond
    time and a zone-free one all read as the same UTC wall clock."""
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq
    root = scratch_path(spark, "enc")
    when = pd.to_datetime(["2024-01-02 14:30:00", "2024-07-02 13:35:00"], utc=True)
    base = {"symbol": ["AAPL", "AAPL"], "open": [1.0, 2.0], "high": [2.0, 3.0],
            "low": [0.5, 1.5], "close": [1.5, 2.5], "volume": [10, 20]}
    for name, typ, values in [("ns", pa.timestamp("ns", tz="UTC"), when),
                              ("us", pa.timestamp("us", tz="UTC"), when),
                              ("ntz", pa.timestamp("us"), when.tz_localize(None))]:
        os.makedirs(f"{root}/{name}")
        table = pa.table({"symbol": base["symbol"], "timestamp": pa.array(values, type=typ),
                          **{k: base[k] for k in ("open", "high", "low", "close", "volume")}})
        pq.write_table(table, f"{root}/{name}/bars_2024.parquet")
    want = [dt.datetime(2024, 1, 2, 14, 30), dt.datetime(2024, 7, 2, 13, 35)]
    for name in ("ntz", "us", "ns"):
        df = read_bars(spark, [f"{root}/{name}"], glob="bars_*.parquet")
        rows = sorted(df.collect(), key=lambda r: r.timestamp)
        assert [r.timestamp for r in rows] == want, name
        assert rows[0].vwap is None and rows[1].volume == 20
        assert df.schema["timestamp"].dataType.simpleString() == "timestamp_ntz"
