"""Reproducible shuffle into shards: a Feistel permutation over global row numbers.

Every row gets a global number 0..n-1 in the order of its key columns. A keyed
Feistel network permutes these numbers; the permuted number p gives the shard
(p mod shards) and the slot in it (p div shards), so both can be computed for
any row number without looking at the data, shard sizes differ by at most one
row, and slots are gapless.

The numbering takes one range exchange of slim rows: rows are dealt by key
range, sorted in their partition, and numbered by partition offset plus place.
No task sees more than its range; the offsets are one row per partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwise.session import checkpoint_root

ROUNDS = 6
_P = 2147483647  # 2^31 - 1: products of two residues stay below 2^62


def domain(n: int) -> tuple[int, int]:
    """Factors a, b with n <= a * b < n + a: the smallest near-square domain."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def feistel(x: Column, n: int, seed: int) -> Column:
    """One pass of the network: a bijection of 0..a*b-1.

    x = hi * b + lo; rounds in turn add a keyed mixing of one half to the
    other. The halves are the state of an aggregate over the round keys, so
    each is computed once.
    """
    a, b = (F.lit(v).cast("long") for v in domain(n))
    keys = F.array(*[F.struct(F.lit(i % 2 == 0).alias("even"),
                              F.lit(1 + (seed * 48271 + 1000003 * (i + 1)) % (_P - 2)).cast("long").alias("mul"),
                              F.lit((seed + 7919 * (i + 1)) % _P).cast("long").alias("add")) for i in range(ROUNDS)])

    def mixed(v: Column, k: Column) -> Column:
        y = (v * k["mul"] + k["add"]) % F.lit(_P).cast("long")
        return (y * y) % F.lit(_P).cast("long")

    def one(s: Column, k: Column) -> Column:
        return F.when(k["even"], F.struct(((s["hi"] + mixed(s["lo"], k)) % a).alias("hi"), s["lo"].alias("lo"))) \
            .otherwise(F.struct(s["hi"].alias("hi"), ((s["lo"] + mixed(s["hi"], k)) % b).alias("lo")))

    start = F.struct(F.floor(x / b).cast("long").alias("hi"), (x % b).alias("lo"))
    return F.aggregate(keys, start, one, lambda s: s["hi"] * b + s["lo"])


def walk_length(spark: SparkSession, n: int, seed: int) -> int:
    """How many extra passes bring every number back below n.

    Only the domain numbers n..a*b-1 (fewer than sqrt n + 1) can prolong a
    walk, so following just these gives the exact bound. Those still outside
    after a step that let none out form closed cycles, which no walk from
    below n can enter.
    """
    a, b = domain(n)
    left, steps = a * b - n, 0
    while left:
        now = spark.range(n, a * b).filter(_walk(F.col("id"), n, seed, steps + 1) >= n).count()
        if now == left:
            break
        left, steps = now, steps + 1
    return steps


def _walk(x: Column, n: int, seed: int, steps: int) -> Column:
    """x, or the first number below n among its next ``steps`` images."""
    out = F.lit(n).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), x.cast("long"),
                       lambda v, i: F.when(v < out, v).otherwise(feistel(v, n, seed)))


def permute(x: Column, n: int, seed: int, walk: int) -> Column:
    """The image of 0 <= x < n under the cycle-walking permutation of 0..n-1."""
    y = feistel(x, n, seed)
    return _walk(y, n, seed, walk) if walk else y


def number_rows(df: DataFrame, keys: list[str], out: str) -> tuple[DataFrame, int]:
    """(df with ``out`` = its place in the order of ``keys``, row count).

    Rows equal in all keys are dealt to neighbouring ranges by a seeded random
    column, so a key that repeats in a third of the rows is split; such rows
    are told apart by nothing, so their order does not matter. Two
    checkpoints: the slim input (read by the range sample and the exchange)
    and the sorted rows (their places must not move between uses).
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    slim = df.withColumn("_tie", F.rand(7)).checkpoint()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(k).asc_nulls_first() for k in keys] + [F.col("_tie")]
    placed = (slim.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie")
              .withColumn("_id", F.monotonically_increasing_id()).checkpoint())
    placed = placed.withColumn("_pid", F.shiftright("_id", 33))
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    n = sizes.agg(F.sum("_n")).first()[0] or 0
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = placed.join(F.broadcast(starts), "_pid")  # bounded by the partition count
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn(out, F.col("_start") + place).drop("_id", "_pid", "_start"), n


def shard(docs: DataFrame, shards: int, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``law`` is 'rows': shard sizes differ by at most one row. ``grown_shard``
    is null, since under this law one more shard moves most rows.

    A null text has no bytes: size 8, crc32 0. Rows are numbered by (doc_id,
    crc32, size), null ids first, so the result does not depend on files or
    partitions; repeated rows get different slots. An empty table gives no
    rows. Other columns are not read.
    """
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.octet_length(raw) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    rows, n = number_rows(slim, ["doc_id", "text_crc32", "size"], "_p")
    if n:
        rows = rows.withColumn("_p", permute(F.col("_p"), n, seed, walk_length(docs.sparkSession, n, seed)))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                       (F.col("_p") % F.lit(shards)).cast("int").alias("shard"),
                       F.floor(F.col("_p") / F.lit(shards)).cast("long").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))
