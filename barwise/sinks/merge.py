"""Insert-ignore and upsert on Parquet tables.

Parquet has no MERGE, so both are joins: insert-ignore is a left anti join
of the batch against the target keys (only new rows are appended);
upsert is a full outer join in which a batch row replaces the named
columns of the target row, nulls included, guarded by a presence flag.
Neither reads and overwrites the same files in one job: results go to a
new location or are appended.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.functions.orderkey import CAPACITY, Part, is_fixed, packed, parts_of
from barwise.operators.quality import assert_unique
from barwise.sinks.tables import PlainTable, staged


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str | Part] | None = None,
                  extra: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties (or all, without an
    order) by a hash of the whole row, so the choice is the same whatever the
    partitions.

    A grouped ``min_by`` of each column over one fixed-width key
    (``functions.orderkey``): a hash aggregate, reduced on the map side, so a
    key with a huge number of duplicates never gathers them in one task.
    Leading order columns go in as long as 40 bits are left for the hash.
    Rows with columns of no fixed width (text) are compared as structs
    instead, by the whole order and then by the row; Spark sorts these.
    ``extra`` aggregates over all rows of a key come as further columns.
    """
    keys = list(keys)
    rest = [c for c in batch.columns if c not in keys]
    schema = batch.schema
    if not rest:
        return batch.groupBy(*keys).agg(*extra) if extra else batch.dropDuplicates(keys)
    if all(is_fixed(schema[c].dataType) for c in rest):
        lead: list[str | Part] = []
        for p in order or ():
            wider = parts_of(schema, [*lead, p])
            if wider is None or sum(w.bits + 1 for w in wider) > CAPACITY - 40:
                break
            lead.append(p)
        rank = packed(schema, lead, F.xxhash64(*rest))
        first = batch.withColumn("_rank", rank).groupBy(*keys).agg(*[F.min_by(c, "_rank").alias(c) for c in rest], *extra)
        return first.select(*batch.columns, *[c for c in first.columns if c not in batch.columns])
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*[F.col(p.column if isinstance(p, Part) else p) for p in order or ()], row)
    first = batch.groupBy(*keys).agg(F.min_by(row, rank).alias("_first"), *extra)
    more = [c for c in first.columns if c not in (*keys, "_first")]
    first = first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest], *more)
    return first.select(*batch.columns, *more)


def first_by_values(batch: DataFrame, keys: Sequence[str], values: Sequence[str], path: str, count: str) -> DataFrame:
    """One row per key of a batch of just keys and ``values``: the first by ``values``, and ``count``, the key's rows.

    For long orders, which fit no packed key of ``first_per_key``. A hash
    aggregate, stored at ``path``, counts rows and has all that keys of one
    row need. If there are others, the batch is read again and their rows are
    compared as structs, for which Spark sorts.
    """
    keys, values = list(keys), list(values)
    seen = staged(batch.groupBy(*keys).agg(*[F.min(c).alias(c) for c in values], F.count(F.lit(1)).alias(count)), path)
    first, torn = seen.where(F.col(count) == 1), seen.where(F.col(count) > 1).select(*keys)
    if torn.isEmpty():
        return first
    t = torn.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    rows = batch.join(t, same, "left_semi").groupBy(*keys).agg(F.min(F.struct(*values)).alias("_first"), F.count(F.lit(1)).alias(count))
    rows = staged(rows.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in values], count), f"{path}-torn")
    return first.unionByName(rows)


def new_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str],
             order: Sequence[str] | None = None) -> DataFrame:
    """Batch rows whose key is not in the target, one per key (K7).

    The target is reduced to the batch's keys first (a semi join, which Spark
    runs as a broadcast of the batch keys when they are small), and to
    distinct keys, so repeated target rows cannot multiply what the final
    anti join handles.
    """
    keys = list(keys)
    b = first_per_key(batch, keys, order)
    existing = target.select(*keys).join(b.select(*keys), keys, "left_semi").distinct()
    return b.join(existing, keys, "left_anti")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                  order: Sequence[str] | None = None) -> DataFrame:
    """target UNION new batch rows: ON CONFLICT DO NOTHING (K7)."""
    return target.unionByName(new_rows(target, batch, keys, order).select(*target.columns))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str],
           cols: Sequence[str] | None = None, check: bool = True) -> DataFrame:
    """ON CONFLICT DO UPDATE SET cols = EXCLUDED.cols (K8).

    A full outer join of both sides; ``upsert_table`` does it for a stored
    table and joins and rewrites only the partitions that the batch touches.

    A key may appear once in the batch (T21; checked when ``check``). Rows
    only in the target are kept, rows only in the batch are inserted, and
    for matched keys the batch's ``cols`` replace the target's, nulls
    included; other columns keep the target's value.
    """
    keys = list(keys)
    others = [c for c in target.columns if c not in keys]
    cols = list(cols) if cols is not None else [c for c in batch.columns if c not in keys]
    if check:
        assert_unique(batch, keys)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in others])
    b = batch.select(*keys, F.lit(True).alias("_in_batch"),
                     *[F.col(c).alias(f"_b_{c}") for c in others if c in batch.columns])
    j = t.join(b, keys, "full_outer")
    out = []
    for c in others:
        if c in cols and c in batch.columns:
            out.append(F.when(F.col("_in_batch"), F.col(f"_b_{c}"))
                       .otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in batch.columns:
            out.append(F.coalesce(F.col(f"_t_{c}"), F.col(f"_b_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*keys, *out)


def touched_parts(table: PlainTable, batch: DataFrame, keys: Sequence[str]) -> list[str]:
    """The table's partitions that hold a key of ``batch``, and those of the batch.

    One name per partition. Stored rows are read for their keys only, and not
    at all if the partition column is one of the keys.
    """
    part = table.part
    found = batch.select(part)
    if table.exists() and part not in keys:
        stored = table.read().select(part, *keys)
        found = found.unionByName(stored.join(batch.select(*keys), list(keys), "left_semi").select(part))
    return sorted(str(r[0]) for r in found.distinct().collect())


def upsert_table(table: PlainTable, batch: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None,
                 check: bool = True) -> list[str]:
    """``upsert`` into a stored table (K8); returns the partitions that were rewritten.

    The batch has the table's partition column. Only the partitions that its
    keys touch are read, joined and replaced; the files of all others stay. A
    row whose partition column changes moves, and a partition left empty by
    that goes. The new partitions are staged and published at once.
    """
    if check:
        assert_unique(batch, list(keys))
    if not table.exists():
        staged = table.stage(batch)
        table.publish(staged, "truncate")
        return staged.parts
    parts = touched_parts(table, batch, keys)
    old = table.read()
    near = old.where(F.col(table.part).cast("string").isin(parts))
    rows = upsert(near, batch, keys, cols, check=False).select(*old.columns)
    table.publish(table.stage(rows), "overwrite", drop=parts)
    return parts


def load_report(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """attempted, inserted, matched (ignored or updated) rows in one job."""
    k = list(keys)
    hit = target.select(*k).distinct().withColumn("_hit", F.lit(True))
    j = batch.join(hit, k, "left")
    return j.agg(F.count(F.lit(1)).alias("attempted"),
                 F.count_if(F.col("_hit").isNull()).alias("inserted"),
                 F.count_if(F.col("_hit")).alias("matched"))


def sort_for_insert(df: DataFrame, order: Sequence[str] = ("ts", "symbol_id")) -> DataFrame:
    """Sort each partition by (ts, symbol_id) before a write."""
    return df.sortWithinPartitions(*order)


def append_new(path: str, target: DataFrame, batch: DataFrame, keys: Sequence[str],
               order: Sequence[str] | None = None, part: str | None = None) -> DataFrame:
    """Append only the new rows of ``batch`` to the table at ``path``. The
    new rows are computed from the old files and written as new files, so
    no file is read and replaced in the same job."""
    rows = new_rows(target, batch, keys, order).select(*target.columns)
    w = rows.write.mode("append")
    if part:
        w = w.partitionBy(part)
    w.parquet(path)
    return rows
