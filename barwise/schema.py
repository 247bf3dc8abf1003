"""Declared schemas. Files are read with these, never inferred.

Bar times are ``TIMESTAMP_NTZ`` holding the UTC wall clock of the bar start:
the instant the reference stores as TIMESTAMPTZ in UTC. Keeping the value
zone-free makes every result independent of the session time zone; local
time is always derived with ``convert_timezone('UTC', tz, ts)``.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Vendor bar file: one Parquet file per calendar year.
BAR_FILE = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
])

BAR_FILE_REQUIRED = ("symbol", "timestamp", "open", "high", "low", "close", "volume")

# The intraday fact (bar_5m), keyed by (ticker_id, ts).
BAR = T.StructType([
    T.StructField("ticker_id", T.IntegerType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("open", T.DoubleType(), False),
    T.StructField("high", T.DoubleType(), False),
    T.StructField("low", T.DoubleType(), False),
    T.StructField("close", T.DoubleType(), False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
])

BAR_COLUMNS = [f.name for f in BAR.fields]

# The daily rollup (bar_1d), keyed by (ticker_id, session_date).
DAILY = T.StructType([
    T.StructField("ticker_id", T.IntegerType(), False),
    T.StructField("session_date", T.DateType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("vwap", T.DoubleType()),
    T.StructField("trade_count", T.LongType()),
])

# Constituents CSV: every column is read as a string.
CONSTITUENT_COLUMNS = ("Symbol", "Security", "GICS Sector", "GICS Sub-Industry",
                       "Headquarters Location", "Date added", "CIK", "Founded")
CONSTITUENTS = T.StructType([T.StructField(c, T.StringType()) for c in CONSTITUENT_COLUMNS])
CONSTITUENTS_REQUIRED = ("Symbol", "Security", "GICS Sector")

EXCHANGE = T.StructType([
    T.StructField("exchange_id", T.ShortType(), False),
    T.StructField("code", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("tz", T.StringType(), False),
])

# Vendor JSON page. Numbers are read as strings and coerced with try_cast,
# so a malformed number becomes null instead of failing the page.
VENDOR_BAR = T.StructType([
    T.StructField("t", T.StringType()),
    T.StructField("o", T.StringType()),
    T.StructField("h", T.StringType()),
    T.StructField("l", T.StringType()),
    T.StructField("c", T.StringType()),
    T.StructField("v", T.StringType()),
    T.StructField("vw", T.StringType()),
    T.StructField("n", T.StringType()),
])
VENDOR_PAGE = T.StructType([
    T.StructField("bars", T.MapType(T.StringType(), T.ArrayType(VENDOR_BAR))),
    T.StructField("next_page_token", T.StringType()),
])
