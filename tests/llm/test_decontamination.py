import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from barwise.llm import decontamination as dc

from .helpers import ALNUM, docs, low, odd_texts, prose, rows_of


def brute(rows, bench, window=10):
    wins = {}
    for item, t in bench:
        w = ALNUM.findall(low(t))
        k = min(window, len(w))
        for s in range(len(w) - k + 1) if k else ():
            wins.setdefault(tuple(w[s:s + k]), set()).add(item)
    out = []
    for i, t in rows:
        w = ALNUM.findall(low(t))
        hit, items = set(), set()
        for k in {len(x) for x in wins}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in wins:
                    hit.update(range(s, s + k))
                    items |= {str(x) for x in wins[tuple(w[s:s + k])] if x is not None}
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def fixture(seed, n=60):
    rng = random.Random(seed)
    vocab = [prose(rng, 1) for _ in range(40)]
    bench = [(i, prose(rng, rng.randint(12, 40), vocab)) for i in range(8)]
    bench += [(8, bench[0][1]), (9, "Two words"), (10, ""), (11, None), (12, bench[1][1] + " tail"), (None, prose(rng, 15, vocab)), (3, "extra text of item three again")]
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    for i in range(100, 100 + n):
        t = prose(rng, rng.randint(0, 60), vocab if rng.random() < 0.5 else None).split()
        if rng.random() < 0.5:
            src = (rng.choice(bench)[1] or "").split()
            a = rng.randint(0, max(0, len(src) - 1))
            t[len(t) // 2:len(t) // 2] = src[a:a + rng.randint(5, 30)]
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(x.upper() if rng.random() < 0.1 else x for x in t)))
    rows += [rows[-1], rows[-1]]
    return rows, bench


COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_hits_equal_brute_force(spark):
    for seed in (1, 2):
        rows, bench = fixture(seed)
        b = spark.createDataFrame(bench, "item_id long, text string")
        want = brute(rows, bench)
        assert rows_of(dc.contamination(docs(spark, rows), b), *COLS) == want
        # Shards of a few texts, and a benchmark in several blocks.
        assert rows_of(dc.contamination(docs(spark, rows), b, shard_bytes=700), *COLS) == want
        assert rows_of(dc.contamination(docs(spark, rows), b, block_bytes=900), *COLS) == want


def test_longest_match_of_each_document_equals_brute_force(spark):
    for seed in (3, 4):
        rows, bench = fixture(seed)
        rows += [(900, bench[0][1] + " and " + bench[1][1]), (901, " ".join(bench[2][1].split()[2:]) + " two words"), (902, "so two words")]
        items = [(None if i is None else str(i), ALNUM.findall(low(t))) for i, t in bench]
        want = []
        for i, text in rows:
            w = ALNUM.findall(low(text))
            best = []
            for item, q in items:
                need = min(10, len(q))
                for s in range(len(w)) if need else ():
                    for a in range(len(q) - need + 1):
                        k = 0
                        while s + k < len(w) and a + k < len(q) and w[s + k] == q[a + k]:
                            k += 1
                        if k >= need:
                            best.append((-k, s, item is None, item))
            m = min(best, key=lambda x: (*x[:3], x[3] or ""), default=(0, None, None, None))
            want.append((i, -m[0], m[1], m[3]))
        b = spark.createDataFrame(bench, "item_id long, text string")
        for options in ({}, {"shard_bytes": 700}, {"block_bytes": 900}):
            got = rows_of(dc.contamination(docs(spark, rows), b, **options), "doc_id", "longest_words", "longest_start", "longest_item")
            assert sorted(got, key=str) == sorted(want, key=str)


def test_suffix_array_is_sorted_and_complete():
    rng = np.random.default_rng(4)
    for alphabet, n in ((1, 40), (2, 300), (30, 300)):
        ranks = rng.integers(-1, alphabet, n).astype(np.int32)
        sa = dc.SuffixArray(ranks, 1)
        suffix = lambda p: ranks[p:p + (np.flatnonzero(np.append(ranks[p:], -1) < 0)[0])].tolist()  # noqa: E731,B023
        got = [suffix(sa.at[p]) for p in sa.order]
        assert got == sorted(got) and sorted(sa.at[sa.order]) == np.flatnonzero(ranks >= 0).tolist()


def test_longest_matches_equal_brute_force(spark):
    rows, bench = fixture(5)
    ids = [(i, t) for i, t in bench if i is not None and i not in (3,)]
    got = {r.item_id: (r.words, r.doc_id, r.start) for r in
           dc.longest_matches(docs(spark, rows), spark.createDataFrame(ids, "item_id long, text string"), shard_bytes=900).collect()}
    want = {}
    for item, t in ids:
        q = ALNUM.findall(low(t))
        need = min(10, len(q))
        for i, text in rows:
            w = ALNUM.findall(low(text))
            for s in range(len(w)) if need else ():
                for a in range(len(q) - need + 1):
                    k = 0
                    while s + k < len(w) and a + k < len(q) and w[s + k] == q[a + k]:
                        k += 1
                    if k >= need:
                        want[str(item)] = min(want.get(str(item), (0,)), (-k, i, s))
    assert got == {k: (-v[0], v[1], v[2]) for k, v in want.items()}


def test_removal_keeps_columns_and_edges(spark):
    rows, bench = fixture(6)
    b = spark.createDataFrame(bench, "item_id long, text string")
    d = docs(spark, rows).withColumn("runs", F.lit(1)).withColumn("doc", F.lit("x")).withColumn("has_hit", F.lit(None).cast("int"))
    left = dc.remove_contaminated(d, b)
    assert left.columns == d.columns
    assert rows_of(left.fillna("", "text"), "doc_id", "text") == sorted((i, t or "") for (i, t), r in zip(sorted(rows, key=lambda x: (x[0], x[1] or "")), sorted(brute(rows, bench))) if not r[5])
    assert dc.contamination(docs(spark, []), b).collect() == []
    empty = dc.contamination(docs(spark, rows), spark.createDataFrame([], "item_id long, text string"))
    assert not any(r.contaminated for r in empty.collect())
