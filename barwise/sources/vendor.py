"""Landed vendor JSON pages to typed bar rows.

A page is ``{"bars": {"<symbol>": [{"t","o","h","l","c","v","vw","n"}]},
"next_page_token": ...}``. The HTTP paging loop of the reference is not
rebuilt; pages land as text (one JSON document per row) and are normalised
by a distributed job: parse, explode the symbol map, explode the bar list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise import schema as S
from barwise.functions.numeric import num_or
from barwise.functions.timefn import vendor_ts


def normalise_pages(pages: DataFrame, text_col: str = "page",
                    missing_vwap: float | None = 0.0) -> DataFrame:
    """Typed bar rows from JSON page text.

    Rows with a missing or unreadable ``t`` are dropped. Prices are coerced
    to double (junk -> null); volume and trade count default to 0 and vwap
    to ``missing_vwap`` (the reference stores 0.0, trap T13; pass None to
    keep null).
    """
    parsed = pages.select(F.from_json(F.col(text_col), S.VENDOR_PAGE).alias("p"))
    per_symbol = parsed.select(F.explode("p.bars").alias("symbol", "bars"))
    rows = per_symbol.select("symbol", F.explode("bars").alias("b"))
    vwap = F.col("b.vw").try_cast("double")
    if missing_vwap is not None:
        vwap = F.coalesce(vwap, F.lit(float(missing_vwap)))
    out = rows.select(
        F.col("symbol"),
        vendor_ts(F.col("b.t")).alias("timestamp"),
        F.col("b.o").try_cast("double").alias("open"),
        F.col("b.h").try_cast("double").alias("high"),
        F.col("b.l").try_cast("double").alias("low"),
        F.col("b.c").try_cast("double").alias("close"),
        num_or(F.col("b.v").try_cast("double").try_cast("bigint"), 0, "bigint").alias("volume"),
        vwap.alias("vwap"),
        num_or(F.col("b.n").try_cast("double").try_cast("bigint"), 0, "bigint").alias("trade_count"),
    )
    return out.where(F.col("timestamp").isNotNull())


def pack_pages(bars: DataFrame, page_key: str = "page_no") -> DataFrame:
    """Bars to vendor-style page text, one page per ``page_key`` value.

    Used to land test pages from bar rows (fixture C). Bars are grouped by
    (page, symbol) and then by page, so no page is built in one task from
    more than its own rows.
    """
    b = F.struct(
        F.format_string("%04d-%02d-%02dT%02d:%02d:%02dZ", F.year("timestamp"),
                        F.month("timestamp"), F.dayofmonth("timestamp"), F.hour("timestamp"),
                        F.minute("timestamp"), F.second("timestamp")).alias("t"),
        F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
        F.col("close").alias("c"), F.col("volume").alias("v"), F.col("vwap").alias("vw"),
        F.col("trade_count").alias("n"))
    per_symbol = bars.groupBy(page_key, "symbol").agg(F.collect_list(b).alias("bars"))
    pages = per_symbol.groupBy(page_key).agg(
        F.map_from_entries(F.collect_list(F.struct("symbol", "bars"))).alias("bars"))
    return pages.select(page_key, F.to_json(F.struct("bars")).alias("page"))
