"""Bar tables derived from the driver's tables (FIXTURES.md section 3).

A. ``bar_5m``: events are trades (price = value, size = props.k) of the
   instrument of the user's nation; five-minute bars per nation. Instruments
   are nations, sectors are regions.
B. ``bar_ship``: lineitems are trades of their supplier on the ship date
   (price = extendedprice / quantity); daily bars per supplier. Instruments
   are suppliers, industries nations, sectors regions.
C. vendor pages: fixture A's bars packed as vendor JSON pages.
D. two load batches of orders split by order date, the second with changed
   prices, giving new, ignored and updated keys.

Everything is derived by Spark from the tables, so work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.functions.numeric import round6
from barwise.functions.orderkey import Part, packed
from barwise.operators.bars import bars_from_ticks
from barwise.operators.joins import bounded_broadcast
from barwise.sources.files import read_table
from barwise.sources.vendor import pack_pages


def ticks_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value", "props"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    j = ev.join(bounded_broadcast(cust), ev.user_id == cust.c_custkey)
    return j.select(F.col("c_nationkey").cast("int").alias("ticker_id"), "ts", "event_id",
                    F.col("value").alias("price"),
                    F.get_json_object("props", "$.k").try_cast("bigint").alias("size"))


def bars_a(spark: SparkSession, sf_dir: str, t0: str | None = None,
           t1: str | None = None) -> DataFrame:
    """bar_5m: five-minute OHLCV bars per nation from events; vwap to 6
    places, as vendors give it.

    With [t0, t1) only the ticks that bars starting in it can hold are read
    (a bar may reach five minutes past t1), so the scan is pruned by time.
    """
    ticks = ticks_a(spark, sf_dir)
    if t0 is not None:
        start, end = (F.lit(t).cast("timestamp_ntz") for t in (t0, t1))
        ticks = ticks.where((F.col("ts") >= start) & (F.col("ts") < end + F.expr("INTERVAL 5 MINUTES")))
    return (bars_from_ticks(ticks, "5 minutes", order=("ts", "event_id"))
            .withColumn("vwap", round6("vwap")))


def instruments_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker_id, symbol, name, sector) for fixture A: nations in regions."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return (n.join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey)
                      .select(F.col("n_nationkey").cast("int").alias("ticker_id"),
                              F.col("n_name").alias("symbol"), F.col("n_name").alias("name"),
                              F.col("r_name").alias("sector")))


def ticks_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey",
                                                "l_quantity", "l_extendedprice", "l_shipdate"])
    return li.select(F.col("l_suppkey").cast("int").alias("ticker_id"),
                     F.col("l_shipdate").alias("ts"), "l_orderkey", "l_linenumber",
                     F.try_divide("l_extendedprice", "l_quantity").alias("price"),
                     F.col("l_quantity"), F.col("l_extendedprice"))


# Unit prices are cents over whole quantities up to 50, so unequal ones differ by more than 2^-24.
TICK_ORDER_B = (Part("l_orderkey", 50), Part("l_linenumber", 8), Part("price", 46, 1 << 24))

HOT_REGIONS = ("AFRICA", "AMERICA")


def ticks_b_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture B with one hot instrument: every supplier of the regions in
    ``HOT_REGIONS`` trades as instrument 0 (about two fifths of the rows)."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    hot = (s.join(bounded_broadcast(n), s.s_nationkey == n.n_nationkey)
           .join(bounded_broadcast(r), n.n_regionkey == r.r_regionkey)
           .where(F.col("r_name").isin(*HOT_REGIONS))
           .select(F.col("s_suppkey").cast("int").alias("ticker_id"),
                   F.lit(True).alias("_hot")))
    t = ticks_b(spark, sf_dir)
    return (t.join(bounded_broadcast(hot), "ticker_id", "left")
            .withColumn("ticker_id", F.when(F.col("_hot"), F.lit(0)).otherwise(F.col("ticker_id")))
            .drop("_hot"))


def bars_b(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """bar_ship: daily OHLCV bars per supplier from lineitem.

    open / close are ordered by (l_orderkey, l_linenumber, price) because
    (l_orderkey, l_linenumber) is not unique in the driver's data (T8).
    vwap = sum(extendedprice) / sum(quantity), to 6 places as vendors give it.
    """
    t = ticks_b_hot(spark, sf_dir) if hot else ticks_b(spark, sf_dir)
    key = packed(t.schema, TICK_ORDER_B)
    shares = F.sum("l_quantity")
    dollars = F.sum("l_extendedprice")
    return (t.groupBy("ticker_id", "ts").agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", key).alias("close"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("volume"),
        round6(F.try_divide(dollars, F.nullif(shares, F.lit(0.0)))).alias("vwap"),
        F.count(F.lit(1)).alias("trade_count")))


def ticker_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    return s.select(F.col("s_suppkey").cast("int").alias("ticker_id"),
                    F.col("s_name").alias("symbol"), F.col("s_name").alias("name"),
                    F.col("s_nationkey").alias("industry_id"))


def industry_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    return n.select(F.col("n_nationkey").alias("industry_id"),
                    F.col("n_regionkey").alias("sector_id"), F.col("n_name").alias("name"))


def sector_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").alias("sector_id"), F.col("r_name").alias("name"))


def instruments_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker_id, symbol, name, industry, sector) through the J2 chain."""
    from barwise.operators.joins import instruments
    return (instruments(ticker_b(spark, sf_dir), industry_b(spark, sf_dir),
                                  sector_b(spark, sf_dir)))


def vendor_rows_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture A's bars in the vendor file layout (symbol, timestamp, ...)."""
    b = bars_a(spark, sf_dir)
    d = bounded_broadcast(instruments_a(spark, sf_dir).select("ticker_id", "symbol"))
    return b.join(d, "ticker_id").select(
        "symbol", F.col("ts").alias("timestamp"), "open", "high", "low", "close", "volume",
        "vwap", "trade_count")


def pages_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture C: vendor JSON pages, one per hour of bars."""
    rows = vendor_rows_a(spark, sf_dir).withColumn(
        "page_no", F.date_format("timestamp", "yyyyMMddHH"))
    return pack_pages(rows)


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def batches_d(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fixture D: batch 1 = orders before 1996; batch 2 = orders from 1995
    on with o_totalprice raised by 1.0. 1995 keys are in both batches."""
    o = read_table(spark, sf_dir, "orders", ORDER_COLS)
    b1 = o.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
    b2 = (o.where(F.col("o_orderdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
          .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(1.0)))
    return b1, b2
