"""Row, key and reference rules.

Spark does not enforce keys or CHECK rules on Parquet, so they are jobs:
row rules split a table into good rows and quarantined rows tagged with
the rules they break; key rules are grouped counts and anti joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bar_rules(nonneg_prices: bool = False, required: Sequence[str] = ()) -> list[tuple[str, Column]]:
    """(name, condition that must hold) for bar rows."""
    h, l, o, c, v = (F.col(x) for x in ("high", "low", "open", "close", "volume"))
    rules = [
        ("high_ge_low", h >= l), ("high_ge_open", h >= o), ("high_ge_close", h >= c),
        ("low_le_open", l <= o), ("low_le_close", l <= c), ("volume_nonneg", v >= 0),
    ]
    if nonneg_prices:
        rules += [(f"{x}_nonneg", F.col(x) >= 0) for x in ("open", "high", "low", "close")]
    rules += [(f"{x}_not_null", F.col(x).isNotNull()) for x in required]
    return rules


def violations(rules: list[tuple[str, Column]]) -> Column:
    """Array of the names of broken rules; a rule whose inputs are null counts
    as passed, like a SQL CHECK, unless a not-null rule says otherwise."""
    tags = [F.when(~F.coalesce(cond, F.lit(True)), F.lit(name)) for name, cond in rules]
    return F.filter(F.array(*tags), lambda x: x.isNotNull())


def check_bars(bars: DataFrame, nonneg_prices: bool = False,
               required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split bars into (good, quarantined); quarantined rows carry
    ``violations`` (P15-P17). good + quarantined = input."""
    tagged = bars.withColumn("violations", violations(bar_rules(nonneg_prices, required)))
    good = tagged.where(F.size("violations") == 0).drop("violations")
    bad = tagged.where(F.size("violations") > 0)
    return good, bad


def violation_counts(bars: DataFrame, nonneg_prices: bool = False,
                     required: Sequence[str] = ()) -> DataFrame:
    """Rows breaking each rule, in one pass: one count_if per rule."""
    rules = bar_rules(nonneg_prices, required)
    return bars.agg(*[F.count_if(~F.coalesce(cond, F.lit(True))).alias(name)
                      for name, cond in rules])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys, keys seen more than once (M4)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.count_if(F.col("n") > 1).alias("duplicated_keys"))


def check_refs(df: DataFrame, dims: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key has no row in ``dims``."""
    return df.join(dims.select(key).distinct(), key, "left_anti")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice (T21: an upsert batch must not)."""
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise ValueError(f"duplicate keys {list(keys)} in batch")


def validate_load(bars: DataFrame, dims: DataFrame, keys: Sequence[str] = ("ticker_id", "ts"),
                  key: str = "ticker_id", ts: str = "ts") -> DataFrame:
    """One-row report on a loaded fact table (P17, A1, P18): rows, first and
    last bar, rows breaking any row rule, duplicated keys and rows whose
    instrument is unknown. Three aggregates over the table, joined as one row."""
    rules = bar_rules()
    bad = F.size(violations(rules)) > 0
    known = dims.select(key).distinct().withColumn("_known", F.lit(True))
    from barwise.operators.joins import bounded_broadcast
    j = bars.join(bounded_broadcast(known), key, "left")
    rows = j.agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"),
                 F.max(ts).alias("last_ts"), F.count_if(bad).alias("rule_violations"),
                 F.count_if(F.col("_known").isNull()).alias("unknown_refs"))
    dups = duplicate_keys(bars, list(keys)).agg(F.count(F.lit(1)).alias("duplicated_keys"))
    return rows.unionByName(dups, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("rows", "first_ts", "last_ts", "rule_violations",
                                      "duplicated_keys", "unknown_refs")])
