"""Table layout: month partitions, yearly exports, bulk load (K1-K6, A4).

A stored bar table is Parquet partitioned by ``month`` ('yyyy-MM', or
'default' outside the supported range), and sorted by (ticker_id, ts)
inside each file, so a per-instrument read skips row groups by min/max and
a time-range read prunes whole month folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barwise.functions.curve import curve_key
from barwise.functions.orderkey import Part
from barwise.functions.timefn import month_key
from barwise.operators.filters import in_range_cond
from barwise.operators.joins import bounded_broadcast
from barwise.operators.quality import bar_rules, violations
from barwise.sinks.merge import first_per_key
from barwise.sinks.tables import PlainTable, VersionedTable, open_table, read_table_at

DEFAULT_PARTITION = "default"


def month_bounds(start: Column, end: Column) -> Column:
    """Array of month starts in [start, end) as dates."""
    s = F.trunc(start.cast("date"), "month")
    last = F.date_sub(end.cast("date"), 1)
    return F.sequence(s, F.trunc(last, "month"), F.expr("INTERVAL 1 MONTH"))


def month_table(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """(month_start, month_end, month_key) rows for each month of each input
    row's [start, end) (K4, F9, F10)."""
    m = df.select(F.explode(month_bounds(start, end)).alias("month_start"))
    return m.select("month_start", F.add_months("month_start", 1).alias("month_end"),
                    month_key("month_start").alias("month_key"))


def year_windows(start: Column, end: Column) -> Column:
    """Array of (window_start, window_end) per calendar year overlapping
    [start, end), clipped to it (F11). Empty when start >= end."""
    s, e = start.cast("date"), end.cast("date")
    years = F.sequence(F.year(s), F.year(F.date_sub(e, 1)))
    return F.when(s < e, F.transform(years, lambda y: F.struct(
        F.greatest(s, F.make_date(y, F.lit(1), F.lit(1))).alias("window_start"),
        F.least(e, F.make_date(y + 1, F.lit(1), F.lit(1))).alias("window_end")))
    ).otherwise(F.array().cast("array<struct<window_start:date,window_end:date>>"))


def assign_month(bars: DataFrame, start, end, ts: str = "ts", out: str = "month") -> DataFrame:
    """Route each row to its month, or 'default' outside [start, end) (K5)."""
    return bars.withColumn(out, F.when(in_range_cond(ts, start, end), month_key(ts))
                           .otherwise(F.lit(DEFAULT_PARTITION)))


def assign_day(bars: DataFrame, start, end, ts: str = "ts", out: str = "day") -> DataFrame:
    """Optional second partition level: 'yyyy-MM-dd' of the UTC bar time, or
    'default' outside [start, end). With it, a read of all instruments at
    one time prunes to one day folder instead of a month."""
    day = F.to_date(F.col(ts)).cast("string")
    return bars.withColumn(out, F.when(in_range_cond(ts, start, end), day)
                           .otherwise(F.lit(DEFAULT_PARTITION)))


def cluster(df: DataFrame, part="month", key: str = "ticker_id", ts: str = "ts",
            partitions: int | None = None, curve_keys: int | None = None) -> DataFrame:
    """Range-partition by (part..., key, ts) and sort inside partitions (K6).

    A range exchange splits a big month (or a hot instrument) over many
    tasks instead of sending a whole month to one writer, and leaves each
    output file sorted by (key, ts) for row-group skipping. ``part`` is a
    partition column or a list of them (e.g. month and day).

    With ``curve_keys`` (the largest key) rows follow a Z-order curve through
    key and time of the month instead: of n files of a month, reads of one key
    and reads of one time each need some sqrt(n), where the plain order needs
    about one for a key and all of them for a time.
    """
    parts = [part] if isinstance(part, str) else list(part)
    cols = [*parts, key, ts]
    if curve_keys is not None:
        df = df.withColumn("_curve", curve_key(F.col(key), F.col(ts), curve_keys))
        cols = [*parts, "_curve", key, ts]
    r = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return r.sortWithinPartitions(*cols).drop("_curve")


WRITE_MODES = ("overwrite", "truncate", "append")


def write_partitioned(df: DataFrame, path: str, part="month", mode: str = "overwrite",
                      max_records_per_file: int | None = 5_000_000) -> None:
    """Write Parquet by ``part`` (K3). ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic overwrite); ``truncate`` replaces
    the whole table; ``append`` adds files."""
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    w = df.write.mode("append" if mode == "append" else "overwrite")
    w = w.option("partitionOverwriteMode", "static" if mode == "truncate" else "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.partitionBy(*([part] if isinstance(part, str) else part)).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything, through the file system of the path."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_partitions(spark: SparkSession, path: str, part: str, values) -> None:
    """Remove whole partition folders of a table."""
    for v in values:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{part}={v}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def load_bars(bars: DataFrame, dims: DataFrame, path: str | PlainTable, start, end,
              mode: str = "overwrite", partitions: int | None = None,
              on_duplicate: str = "fail", report: dict | None = None,
              by_day: bool = False, on_bad: str = "fail", curve: bool = False) -> DataFrame:
    """Bulk load vendor bars into the month-partitioned fact (K2, K3, K6).

    Symbols are resolved with a broadcast-checked join, unknown symbols are
    dropped (P13), rows are routed to months (K5), clustered (K6) and staged;
    the table changes only once the staged rows have passed the checks
    (``sinks.tables``; ``path`` may be a table, such as a versioned one). A
    (ticker_id, ts) key seen twice fails the load like the first loader's
    primary key (``on_duplicate="fail"``), or keeps the first row by open
    price like the second loader's DO NOTHING (``"first"``). With
    ``mode="append"`` the keys already stored in the staged months count as
    well: ``"fail"`` refuses the load, ``"first"`` adds only new keys.
    ``mode="truncate"`` replaces the whole table, ``"overwrite"`` the months
    present. Rows that break the bar rules are refused (``on_bad="fail"``),
    left out (``"drop"``) or kept (``"keep"``). A refused load raises
    ValueError and leaves the table as it was. ``curve`` clusters the files by
    instrument and time alike (see ``cluster``).

    The input is scanned once: rows are reduced per key by a hash aggregate
    that counts duplicates and bad rows on the way, and the range exchange
    samples that aggregate's output. The counters are observed while the rows
    are written. Returns the per-month row counts of what was written (K9),
    read back from the table. A ``report`` dict is filled with the counters
    attempted, unknown_symbols, loaded, default_partition, duplicates and
    bad_rows.
    """
    if on_duplicate not in ("fail", "first"):
        raise ValueError("on_duplicate must be 'fail' or 'first'")
    if on_bad not in ("keep", "fail", "drop"):
        raise ValueError("on_bad must be 'keep', 'fail' or 'drop'")
    spark = bars.sparkSession
    table = open_table(spark, path)
    curve_keys = (dims.agg(F.max("ticker_id")).first()[0] or 0) if curve else None
    out, seen = checked_rows(bars, dims, start, end, partitions, by_day, on_bad, curve_keys)
    parts = ["month", "day"] if by_day else ["month"]
    staged = table.stage(out, parts)
    counts = seen.get
    stop = None
    if on_bad == "fail" and counts["bad_rows"]:
        stop = f"load_bars: {counts['bad_rows']} rows break the bar rules"
    elif on_duplicate == "fail" and counts["duplicates"]:
        stop = f"load_bars: {counts['duplicates']} duplicate keys ['ticker_id', 'ts'] in batch"
    elif mode == "append" and table.exists():
        rows, keys = table.staged_rows(staged), ["ticker_id", "ts"]
        stored = table.read().where(F.col("month").isin(staged.parts)).select(*keys)
        if not stored.join(rows.select(*keys), keys, "left_semi").isEmpty():
            if on_duplicate == "fail":
                stop = "load_bars: keys are already stored"
            else:
                fresh = table.stage(cluster(rows.join(stored, keys, "left_anti").select(*rows.columns), part=parts, partitions=partitions, curve_keys=curve_keys), parts)
                table.discard(staged)
                staged = fresh
    if stop:
        table.discard(staged)
        raise ValueError(stop)
    table.publish(staged, mode)
    if report is not None:
        report.update(counts)
    if not table.exists():  # nothing was loaded yet
        return spark.createDataFrame([], "month string, rows bigint")
    return table.read().groupBy("month").agg(F.count(F.lit(1)).alias("rows"))


def checked_rows(bars: DataFrame, dims: DataFrame, start, end, partitions: int | None = None, by_day: bool = False,
                 on_bad: str = "fail", curve_keys: int | None = None) -> tuple[DataFrame, Observation]:
    """(the rows of a load, clustered, one per key; the counters, known once they are written)."""
    d = bounded_broadcast(dims.select("symbol", "ticker_id"))
    b = (bars.join(d, "symbol", "left")
         .select("ticker_id", F.col("timestamp").alias("ts"), "open", "high", "low", "close",
                 "volume", "vwap", F.col("trade_count").cast("bigint").alias("trade_count")))
    known = F.col("ticker_id").isNotNull()
    bad = known & (F.size(violations(bar_rules())) > 0)
    if on_bad == "drop":
        b = b.where(~bad)
    # Unknown symbols have a null ticker_id: they are counted and go after the exchange.
    b = first_per_key(b, ["ticker_id", "ts"], [Part("open", 62)],
                      [F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_bad")])
    b = assign_month(b, start, end)
    parts = ["month"]
    if by_day:
        b, parts = assign_day(b, start, end), ["month", "day"]
    # The counters are observed above the range exchange: below it they
    # would also be counted by the exchange's sampling job.
    seen = Observation("load_bars")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = (cluster(b, part=parts, partitions=partitions, curve_keys=curve_keys)
           .observe(seen, total(F.when(known, 1).otherwise(F.col("_n"))).alias("attempted"),
                    total(F.when(~known, F.col("_n"))).alias("unknown_symbols"),
                    F.count_if(known).alias("loaded"),
                    F.count_if(known & (F.col("month") == DEFAULT_PARTITION)).alias("default_partition"),
                    total(F.when(known, F.col("_n") - 1)).alias("duplicates"),
                    total("_bad").alias("bad_rows"))
           .where(known).drop("_n", "_bad"))
    return out, seen


def write_yearly(bars: DataFrame, path: str, ts: str = "timestamp") -> None:
    """One Parquet folder per calendar year; rewriting a year replaces it
    and leaves the other years alone (K1)."""
    y = bars.withColumn("year", F.year(ts))
    (y.repartitionByRange("year", "symbol", ts).sortWithinPartitions("year", "symbol", ts)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(path))


def read_partitioned(spark: SparkSession, path: str | PlainTable) -> DataFrame:
    """The stored table: the newest version of a versioned one, else the Parquet folder."""
    return read_table_at(spark, path)


__all__ = ["DEFAULT_PARTITION", "month_bounds", "month_table", "year_windows", "assign_month",
           "assign_day",
           "cluster", "drop_partitions", "table_exists", "write_partitioned", "load_bars", "write_yearly", "read_partitioned",
           "PlainTable", "VersionedTable", "open_table", "checked_rows"]
