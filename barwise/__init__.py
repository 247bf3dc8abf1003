"""barwise: market-bar analytics as Spark DataFrame jobs.

Bars (OHLCV per instrument and time) are loaded from Parquet, CSV and
landed vendor JSON, checked, kept in month-partitioned Parquet tables and
queried for all instruments at once: charts, cross-sections, top movers,
rolling volatility, daylight-saving-correct daily rollups (also kept as a
maintained table) and market-wide volume.
"""

__version__ = "0.1.0"
