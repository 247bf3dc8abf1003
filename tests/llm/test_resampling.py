import hashlib
import math
import random
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barwise.llm import resampling as rs

from .helpers import ALNUM, docs, low, odd_texts, prose

COLS = ("doc_id", "n_features", "weight", "score", "rank")


def grams(text, max_n):
    w = ALNUM.findall(low(text))
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)], len(w)


def brute(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed="2024"):
    count = [[0] * buckets, [0] * buckets]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    for k, texts in enumerate(([t for _, t in rows], target)):
        for t in texts:
            for g in grams(t, max_n)[0]:
                count[k][bucket(g)] += 1
    s_all, t_all = (float(sum(c) + buckets) for c in count)
    gain = [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(*count)]
    out = []
    for i, t in rows:
        gs, n = grams(t, max_n)
        w = sum(gain[bucket(g)] for g in gs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(gs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = able[:percent * len(able) // 100]
    rest = able[len(drawn):] + [r for r in out if not r[4]]
    return sorted([(*r[:4], k + 1) for k, r in enumerate(drawn)] + [(*r[:4], None) for r in rest], key=str)


def bench(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=str)


@pytest.mark.parametrize("max_n", [1, 2, 3])
def test_equals_plain_python(spark, max_n):
    rng = random.Random(max_n)
    vocab = prose(rng, 300).split()
    rows = [(i, prose(rng, rng.randint(0, 60), vocab)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    target = [prose(rng, 50, vocab[:40]) for _ in range(20)] + [None, ""]
    assert got(rs.resample(docs(spark, rows), bench(spark, target), max_n)) == brute(rows, target, max_n)


def test_draw_favours_the_target(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 40, ["alpha", "beta", "gamma"] if i % 4 else ["delta", "eps", "zeta"])) for i in range(400)]
    out = rs.resample(docs(spark, rows), bench(spark, ["delta eps zeta " * 50])).filter("rank is not null").collect()
    assert len(out) == 40 and all(r.doc_id % 4 == 0 for r in out)
    assert sorted(r["rank"] for r in out) == list(range(1, 41))


def test_repeated_rows_ties_and_null_ids(spark):
    text = "one two three four " * 6
    rows = [(5, text)] * 30 + [(None, text)] * 3 + [(5, text + "five"), (6, None), (7, "")]
    target = ["two three"]
    one, two = (got(rs.resample(docs(spark, rows, p), bench(spark, target), percent=50)) for p in (1, 6))
    assert one == two == brute(rows, target, percent=50)


def test_few_buckets_collide_alike(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 30)) for i in range(50)]
    target = [prose(rng, 30)]
    assert got(rs.resample(docs(spark, rows), bench(spark, target), 2, buckets=7)) == brute(rows, target, 2, 7)


def test_empty_tables_and_clashing_columns(spark):
    assert got(rs.resample(docs(spark, []), bench(spark, ["a b"]))) == []
    rows = [(i, "some words " * 15) for i in range(20)]
    assert got(rs.resample(docs(spark, rows), bench(spark, []))) == brute(rows, [])
    extra = docs(spark, rows).withColumn("weight", F.lit("x")).withColumn("n_words", F.lit(0)).withColumn("place", F.lit(1)).withColumn("short", F.lit(True))
    assert got(rs.resample(extra, bench(spark, []))) == brute(rows, [])


def test_parts_keep_rows_and_bytes():
    texts = pa.array(["a" * n for n in (0, 5, 9, 100, 0, 3)] + [None])
    cut = list(rs.parts(texts, 10))
    assert [len(c) for c in cut] == [2, 1, 1, 3]
    assert [x for c in cut for x in c.to_pylist()] == [t or "" for t in texts.to_pylist()]
