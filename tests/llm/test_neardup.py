import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwise.llm import neardup as nd
from barwise.llm import setsketch as ss

from .helpers import WORDS, docs, low, odd_texts, prose, rows_of


def shingles(t, k):
    w = WORDS.findall(low(t))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent=80):
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def fixture(seed, groups=6):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = prose(rng, rng.choice([4, 30, 120])).split()
        for _ in range(rng.randint(2, 9)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 8))):
                t[rng.randrange(len(t))] = prose(rng, 1)
            rows.append((rng.randrange(10**6), " ".join(t)))
    rows += [(10**6 + i, prose(rng, rng.randint(1, 60))) for i in range(20)]
    rows += [(2 * 10**6 + i, t) for i, t in enumerate(odd_texts())] + [(3 * 10**6, "WORD"), (3 * 10**6 + 1, rows[0][1].upper())]
    return list(dict(rows).items())


COLS = ("doc_id", "n_shingles", "component_id", "kept")


@pytest.mark.parametrize("block", [512, 4])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)  # 4: groups are dealt over several blocks
    rows = fixture(7)
    assert rows_of(nd.classify(docs(spark, rows), 2), *COLS) == brute(rows, 2)


def test_five_word_shingles_and_threshold_ties(spark):
    # 8 common of 10 shingles: exactly 80 percent; and 7 of 10.
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words[:9])), (2, " ".join(words[:10] + ["x"])), (3, " ".join(words[20:29])), (4, " ".join(words[20:28] + ["y", "z", "q"]))]
    assert rows_of(nd.classify(docs(spark, rows), 2), *COLS) == brute(rows, 2)
    rows = fixture(8, 3)
    assert rows_of(nd.classify(docs(spark, rows), 5), *COLS) == brute(rows, 5)


def test_null_ids_repeated_rows_empty_table(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "lonely text here"), (7, None), (7, "a b c d")]
    got = sorted(nd.classify(docs(spark, rows), 2).select(*COLS).collect(), key=str)
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id) == [(5, 5, True), (5, 5, True), (7, 5, False), (7, 7, True)]
    assert sorted((str(r.component_id), r.kept) for r in got if not r.doc_id) == [("5", False), ("None", True)]
    assert nd.classify(docs(spark, []), 2).collect() == []


def test_drop_copies_keeps_columns_and_one_of_each(spark):
    rows = fixture(9, 3)
    d = docs(spark, rows + [rows[0]]).withColumn("node", F.lit(1)).withColumn("comp", F.lit("c")).withColumn("key", F.lit(2))
    left = nd.drop_copies(d, 2)
    assert left.columns == d.columns
    assert rows_of(left, "doc_id") == [(r[0],) for r in brute(rows, 2) if r[3]]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 900, dtype=np.uint64)
    a, b = x[:500], x[100:]
    sk = lambda e: ss.registers(e, np.array([0, len(e)]))
    assert (ss.merge(sk(a), sk(b)) == sk(np.unique(x))).all()
    est = ss.similarity(sk(a), sk(b), np.array([500]), np.array([800]))[0]
    assert abs(est - 400 / 900) < 0.15


def test_a_row_repeated_often_is_one_node(spark, monkeypatch):
    rng = random.Random(5)
    base = prose(rng, 60).split()
    near = " ".join(base[:-1] + ["other"])
    sizes = []
    exact = nd._exact
    monkeypatch.setattr(nd, "sets", lambda d, k, real=nd.sets: sizes.append(d.count()) or real(d, k))
    monkeypatch.setattr(nd, "_exact", exact)
    rows = [(5, " ".join(base))] * 300 + [(6, near)]
    got = rows_of(nd.classify(docs(spark, rows), 2), "doc_id", "component_id", "kept")
    assert sizes == [2] and got == [(5, 5, True)] * 300 + [(6, 5, False)]


def test_an_id_with_different_texts_keeps_each_text(spark):
    rng = random.Random(6)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(5, a), (5, b), (7, a + " tail"), (3, b + " tail")]
    assert rows_of(nd.classify(docs(spark, rows), 2), "doc_id", "component_id", "kept") == [(3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False)]
    assert rows_of(nd.drop_copies(docs(spark, rows), 2), "doc_id", "text") == [(3, b + " tail"), (5, a)]


def test_drop_copies_of_rows_without_an_id(spark):
    rng = random.Random(7)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a), (None, a), (None, a + " tail"), (None, b), (None, b), (None, b + " tail"), (None, "lonely text here"), (None, None), (None, "")]
    left = [(r.doc_id, r.text) for r in nd.drop_copies(docs(spark, rows), 2).collect()]
    assert (1, a) in left and sum((t or "").startswith(b) for _, t in left) == 1
    assert sorted(str(t) for _, t in left if not (t or "").startswith(b)) == sorted(["None", "", "lonely text here", a])
