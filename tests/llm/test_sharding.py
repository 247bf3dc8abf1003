import random
import zlib

from pyspark.sql import functions as F

from barwise.llm import sharding as sh

from .helpers import docs, odd_texts, prose


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 10, 97, 1000, 1024):
        walk = sh.walk_length(spark, n, 17)
        got = spark.range(n).select(sh.permute(F.col("id"), n, 17, walk).alias("p")).collect()
        assert sorted(r.p for r in got) == list(range(n))


def test_shards_sizes_slots_and_digests(spark):
    rng = random.Random(1)
    rows = [(i * 7 % 503, prose(rng, rng.randint(0, 40))) for i in range(503)] + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    got = sh.shard(docs(spark, rows), 24).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        raw = (dict(rows)[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_same_result_for_any_partitioning_and_repeated_rows(spark):
    rows = [(i % 50, f"t{i % 50}") for i in range(200)] + [(None, None)] * 9
    one, two = (sorted(map(str, sh.shard(docs(spark, rows, p), 5).collect())) for p in (1, 7))
    assert one == two and len(one) == 209


def test_empty_table_and_extra_columns(spark):
    none = docs(spark, [])
    assert sh.shard(none, 24).collect() == []
    extra = docs(spark, [(1, "a"), (2, "b")]).withColumn("_p", F.lit("x")).withColumn("shard", F.lit(9)).withColumn("_id", F.lit(0))
    assert {r.slot for r in sh.shard(extra, 24).collect()} == {0}
