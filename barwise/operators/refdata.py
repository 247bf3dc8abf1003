"""Reference data: sectors, industries, instruments, exchanges, symbol
resolution and the trading calendar (R1-R8, J8, J9, J11, O5).

These tables are dimension-sized. Surrogate ids use ``row_number()`` over
the whole table, which runs in one task; that is only done for dimensions
(sectors, industries, instruments), never for facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions.numeric import int_or_null
from barwise.functions.text import clean_symbol, empty_to_null, not_blank, symbol_forms
from barwise.functions.timefn import is_early_close, local_date
from barwise.operators.joins import bounded_broadcast
from barwise.operators.numbering import number_rows

# Symbols tagged as Nasdaq listings; every other symbol is NYSE.
NASDAQ_SYMBOLS = (
    "AAPL", "ABNB", "ADBE", "ADI", "ADP", "ADSK", "AEP", "ALGN", "AMAT", "AMD",
    "AMGN", "AMZN", "ANSS", "APP", "ARM", "ASML", "AVGO", "AZN", "BIIB", "BKNG",
    "BKR", "CCEP", "CDNS", "CDW", "CEG", "CHTR", "CMCSA", "COST", "CPRT", "CRWD",
    "CSCO", "CSGP", "CSX", "CTAS", "CTSH", "DASH", "DDOG", "DLTR", "DXCM", "EA",
    "EBAY", "EXC", "FANG", "FAST", "FI", "FTNT", "GEHC", "GFS", "GILD", "GOOG",
    "GOOGL", "HON", "IDXX", "ILMN", "INTC", "INTU", "ISRG", "KDP", "KHC", "KLAC",
    "LIN", "LRCX", "LULU", "MAR", "MCHP", "MDB", "MDLZ", "MELI", "META", "MNST",
    "MRNA", "MRVL", "MSFT", "MU", "NFLX", "NVDA", "NXPI", "ODFL", "ON", "ORLY",
    "PANW", "PAYX", "PCAR", "PDD", "PEP", "PYPL", "QCOM", "REGN", "ROP", "ROST",
    "SBUX", "SIRI", "SMCI", "SNPS", "TEAM", "TMUS", "TSLA", "TTD", "TTWO", "TXN",
    "VRSK", "VRTX", "WBA", "WBD", "WDAY", "XEL", "ZS",
)


def assign_ids(names: DataFrame, existing: DataFrame | None = None, id_col: str = "id",
               name_cols: Sequence[str] = ("name",)) -> DataFrame:
    """Stable surrogate ids (R4): names already present keep their id, new
    ones get max(id) + 1, 2, ... in name order, numbered over all tasks."""
    names = names.select(*name_cols).distinct()
    if existing is None:
        return (number_rows(names, name_cols, "_no")
                .select(F.col("_no").cast("int").alias(id_col), *name_cols))
    known = existing.select(id_col, *name_cols)
    kind = known.schema[id_col].dataType
    top = known.agg(F.max(id_col)).first()[0] or 0
    fresh = number_rows(names.join(known.select(*name_cols), list(name_cols), "left_anti"), name_cols, "_no")
    return known.unionByName(fresh.select((F.col("_no") + top).cast(kind).alias(id_col), *name_cols))


def build_sectors(const: DataFrame, existing: DataFrame | None = None,
                  sector_col: str = "GICS Sector") -> DataFrame:
    """sector(sector_id, name) from constituents."""
    names = const.select(F.trim(F.col(sector_col)).alias("name")).where(not_blank("name"))
    return assign_ids(names, existing, "sector_id")


def build_industries(const: DataFrame, sectors: DataFrame, existing: DataFrame | None = None,
                     sector_col: str = "GICS Sector",
                     industry_col: str = "GICS Sub-Industry") -> DataFrame:
    """industry(industry_id, sector_id, name), unique per (sector, name)."""
    pairs = const.select(F.trim(F.col(sector_col)).alias("sector"),
                         F.trim(F.col(industry_col)).alias("name")).distinct()
    s = bounded_broadcast(sectors.select("sector_id", F.col("name").alias("sector")))
    keyed = pairs.join(s, "sector").select("sector_id", "name")
    return assign_ids(keyed, existing, "industry_id", ("sector_id", "name"))


def tag_exchange(df: DataFrame, nasdaq=NASDAQ_SYMBOLS, symbol_col: str = "symbol",
                 out: str = "exchange_code") -> DataFrame:
    """'XNAS' for symbols in the Nasdaq list, else 'XNYS' (R3, P11).

    ``nasdaq`` is a short literal list (an IN list) or a one-column
    DataFrame of symbols (a broadcast-checked semi join for long lists).
    """
    if isinstance(nasdaq, DataFrame):
        lst = nasdaq.select(F.col(nasdaq.columns[0]).alias("_nq")).distinct()
        lst = lst.withColumn("_hit", F.lit(True))
        j = df.join(bounded_broadcast(lst), F.col(symbol_col) == F.col("_nq"), "left")
        return (j.withColumn(out, F.when(F.col("_hit"), "XNAS").otherwise("XNYS"))
                .drop("_nq", "_hit"))
    return df.withColumn(out, F.when(F.col(symbol_col).isin(list(nasdaq)), "XNAS")
                         .otherwise("XNYS"))


def build_tickers(const: DataFrame, sectors: DataFrame, industries: DataFrame,
                  exchanges: DataFrame, nasdaq=NASDAQ_SYMBOLS,
                  existing: DataFrame | None = None, order_col: str = "row_no") -> DataFrame:
    """ticker rows from constituents (R2, J8, F13, F16): natural keys
    (sector name, industry name, exchange code) resolved to ids; CIK parsed
    or null; empty headquarters and dates become null."""
    order = F.col(order_col) if order_col in const.columns else F.lit(0)
    c = const.select(
        order.alias("_order"), F.trim("Symbol").alias("symbol"), F.trim("Security").alias("name"),
        F.trim("GICS Sector").alias("sector"), F.trim("GICS Sub-Industry").alias("industry"),
        int_or_null("CIK").alias("cik"),
        empty_to_null("Headquarters Location").alias("headquarters"),
        empty_to_null("Date added").try_cast("date").alias("date_added"))
    # A symbol listed twice: the last row in file order wins, as with one upsert per row.
    rest = [x for x in c.columns if x != "symbol"]
    c = (c.groupBy("symbol").agg(F.max(F.struct(*rest)).alias("_last"))
         .select("symbol", *[F.col(f"_last.{x}").alias(x) for x in rest]).drop("_order"))
    c = tag_exchange(c, nasdaq)
    sec = bounded_broadcast(sectors.select("sector_id", F.col("name").alias("sector")))
    ind = bounded_broadcast(industries.select("industry_id", "sector_id",
                                              F.col("name").alias("industry")))
    ex = bounded_broadcast(exchanges.select("exchange_id", F.col("code").alias("exchange_code")))
    t = (c.join(sec, "sector").join(ind, ["sector_id", "industry"]).join(ex, "exchange_code")
         .select("symbol", "name", "exchange_id", "industry_id", "cik", "headquarters",
                 "date_added", F.lit(True).alias("is_active")))
    ids = assign_ids(t.select("symbol"), existing.select("ticker_id", "symbol")
                     if existing is not None else None, "ticker_id", ("symbol",))
    return t.join(ids, "symbol")


def list_symbols(ticker: DataFrame, industry: DataFrame, sector: DataFrame) -> DataFrame:
    """symbol, name, sector, industry ordered by symbol."""
    from barwise.operators.joins import instruments
    return (instruments(ticker, industry, sector)
            .select("symbol", "name", "sector", "industry").orderBy("symbol"))


def resolve_symbols(const: DataFrame, tradable: DataFrame, max_symbols: int | None = None,
                    order_col: str = "row_no", symbol_col: str = "Symbol"
                    ) -> tuple[DataFrame, DataFrame]:
    """Constituent symbols to tradable symbols.

    For each input row (in ``order_col`` order) the first of [raw, '.'->'-',
    '-'->'.'] that is tradable is picked; a symbol picked by an earlier row
    is a duplicate. At most ``max_symbols`` are kept. Returns (resolved rows
    with ``pick``, one-row counts: resolved, skipped). Skipped rows are those
    before the cut-off with no tradable form or a duplicate pick.
    """
    c = (const.select(order_col, clean_symbol(symbol_col).alias("raw"))
         .where(not_blank("raw")))
    cand = c.select(order_col, F.posexplode(symbol_forms("raw")).alias("pos", "cand"))
    trad = bounded_broadcast(tradable.select(F.col(tradable.columns[0]).alias("cand")).distinct())
    best = (cand.join(trad, "cand").groupBy(order_col)
            .agg(F.min_by("cand", F.col("pos")).alias("pick")))
    rows = c.join(best, order_col, "left")
    # The first row of each pick, by a grouped minimum; rows without a pick stay out of it.
    firsts = (rows.where(F.col("pick").isNotNull()).groupBy("pick")
              .agg(F.min(order_col).alias(order_col)).withColumn("ok", F.lit(True)))
    rows = (rows.join(firsts, ["pick", order_col], "left")
            .withColumn("ok", F.coalesce("ok", F.lit(False))))
    if max_symbols is not None:
        # Rows are walked in order until max_symbols are picked: up to the last of them.
        top = firsts.orderBy(order_col).limit(max_symbols)
        n, last = top.agg(F.count(F.lit(1)), F.max(order_col)).first()
        if n == max_symbols:
            rows = rows.where(F.col(order_col) <= F.lit(last))
    resolved = rows.where("ok").select(order_col, "raw", "pick")
    counts = rows.agg(F.count_if(F.col("ok")).alias("resolved"),
                      F.count_if(~F.col("ok")).alias("skipped"))
    return resolved, counts


def symbol_variants(const: DataFrame, order_col: str = "row_no", symbol_col: str = "Symbol",
                    name_col: str = "Security", sector_col: str = "GICS Sector") -> DataFrame:
    """Every spelling (raw, '.'->'-', '-'->'.') of each symbol mapped to its
    (name, sector); a later row wins a repeated spelling (R6, P14)."""
    c = const.select(order_col, clean_symbol(symbol_col).alias("raw"),
                     F.trim(F.col(name_col)).alias("name"),
                     F.coalesce(F.trim(F.col(sector_col)), F.lit("Unknown")).alias("sector"))
    c = c.where(not_blank("raw")).withColumn("name", F.coalesce("name", "raw"))
    keys = c.select(order_col, "name", "sector",
                    F.explode(F.array_distinct(symbol_forms("raw"))).alias("symbol"))
    last = F.max_by(F.struct("name", "sector"), F.col(order_col))
    return keys.groupBy("symbol").agg(last.alias("v")).select("symbol", "v.name", "v.sector")


def sessions_from_bars(bars: DataFrame, width_minutes: int = 5, tz: str = "America/New_York",
                       ts: str = "ts") -> DataFrame:
    """Trading sessions observed in bars: local date, first bar start and
    last bar end (UTC), per time zone ``tz``."""
    return (bars.groupBy(local_date(ts, tz).alias("session_date"))
            .agg(F.min(ts).alias("open_ts"),
                 F.timestamp_add("MINUTE", F.lit(width_minutes), F.max(ts)).alias("close_ts"))
            .withColumn("tz", F.lit(tz)))


def build_calendar(sessions: DataFrame, exchanges: DataFrame,
                   early_cutoff: str = "19:30") -> DataFrame:
    """trading_calendar rows: each session for each exchange in the
    session's time zone, with the early-close flag (R7, J11, F18).

    The exchange list is joined on the time zone (an equi join against a
    broadcast-checked table), so each session meets only its exchanges.
    """
    ex = bounded_broadcast(exchanges.select("exchange_id", "tz"))
    return (sessions.join(ex, "tz")
            .select("exchange_id", "session_date", "open_ts", "close_ts",
                    is_early_close(F.col("close_ts"), early_cutoff).alias("is_early_close")))


TICKER_ATTRS = ["name", "exchange_id", "industry_id", "cik", "headquarters", "date_added"]


def refresh_tickers(existing: DataFrame, const: DataFrame, sectors: DataFrame,
                    industries: DataFrame, exchanges: DataFrame,
                    nasdaq=NASDAQ_SYMBOLS) -> DataFrame:
    """Re-seed the ticker table (R2): new symbols get new ids, known symbols
    keep theirs and have their attributes replaced (upsert by symbol, K8)."""
    from barwise.sinks.merge import upsert
    fresh = build_tickers(const, sectors, industries, exchanges, nasdaq, existing)
    return upsert(existing, fresh.select(*existing.columns), ["symbol"], TICKER_ATTRS)


def refresh_calendar(existing: DataFrame | None, sessions: DataFrame, exchanges: DataFrame,
                     early_cutoff: str = "19:30") -> DataFrame:
    """Upsert session rows by (exchange_id, session_date)."""
    from barwise.sinks.merge import upsert
    rows = build_calendar(sessions, exchanges, early_cutoff)
    if existing is None:
        return rows
    return upsert(existing, rows, ["exchange_id", "session_date"],
                  ["open_ts", "close_ts", "is_early_close"])
