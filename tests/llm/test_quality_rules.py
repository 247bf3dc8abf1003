import random

import numpy as np
from pyspark.sql import functions as F

from barwise.llm import quality_rules as qr

from .helpers import WORDS, docs, odd_texts, prose


def base(t):
    t = t or ""
    w = WORDS.findall(t)
    seen = {}
    for s in range(len(w) - 4):
        seen.setdefault(tuple(w[s:s + 5]), []).append(s)
    cover = {x for v in seen.values() if len(v) > 1 for s in v for x in range(s, s + 5)}
    lines = [x for x in t.split("\n") if WORDS.search(x)]
    stats = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))
    return stats, len(w) < 10 or 100 * len(cover) > 20 * len(w)


def fixture():
    rng = random.Random(4)
    rows = [(i, t, None, "odd") for i, t in enumerate(odd_texts())]
    rows += [(100 + i, prose(rng, rng.randint(30, 300)).replace("the", "the."), "en", "src0") for i in range(150)]
    rows += [(300 + i, prose(rng, rng.randint(30, 300)), rng.choice(["fr", None]), f"s{i % 30}") for i in range(90)]
    rows += [(400 + i, " ".join(w + "###" for w in prose(rng, 80).split()), "en", "src0") for i in range(8)]
    line = prose(rng, 12)
    rows += [(500 + i, "\n".join([line] * (i % 4) + [prose(rng, 20), prose(rng, 60)]), "en", "src0") for i in range(12)]
    return rows + [rows[-1]]


COLS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_statistics_and_limits_equal_brute_force(spark):
    rows = fixture()
    got = qr.verdicts(docs(spark, rows).withColumn("s", F.lit(1)).withColumn("pool", F.lit("p"))).collect()
    want = sorted((r[0], *base(r[1])[0], base(r[1])[1]) for r in rows)
    assert sorted(tuple(r[c] for c in COLS) for r in got) == want
    by = {r.doc_id: r for r in got}
    assert not any(r.kept for r in got if r.base_failed)
    assert not any(by[400 + i].kept for i in range(8))
    clean = [by[i].kept for i in [*range(100, 250), *range(300, 390)]]
    assert sum(clean) >= 0.98 * len(clean)
    assert qr.verdicts(docs(spark, [])).collect() == []


def test_distances_equal_numpy_estimates(spark):
    rows = [r for r in fixture() if r[3] == "src0"]
    got = {r.doc_id: r.distance for r in qr.verdicts(docs(spark, rows)).collect()}
    ids, x, n = [], [], []
    for i, t, *_ in dict((r[0], r) for r in rows).values():
        (nw, wc, sy, _, rep), failed = base(t)
        if not failed:
            letters = sum(c.isalpha() for c in t)
            ids.append(i)
            n.append(nw)
            x.append([np.log(wc / nw), np.sqrt(sy / wc), np.arcsin(np.sqrt(1 - letters / wc)), np.sqrt(rep / nw)])
    again = [i for i, r in enumerate(rows) if r[0] == rows[-1][0]]  # the repeated row counts twice
    if len(again) > 1 and rows[-1][0] in ids:
        k = ids.index(rows[-1][0])
        ids, x, n = ids + [ids[k]], x + [x[k]], n + [n[k]]
    x, n = np.array(x), np.array(n, float)
    rank = lambda q: np.sort(x, axis=0)[int(np.ceil(q * len(x))) - 1]
    floors = np.array(qr.FLOORS)
    y = (x - rank(0.5)) * np.sqrt(n / (n + qr.STEADY_WORDS))[:, None]
    center, factor = np.zeros(4), np.diag(np.maximum((rank(0.75) - rank(0.25)) / 1.349, floors))
    dist = lambda: (np.linalg.solve(factor, (y - center).T) ** 2).sum(axis=0)
    for _ in range(qr.STEPS):
        bins = np.minimum(np.floor(np.log1p(dist()) * 24), qr.BINS - 1)
        before = np.array([(bins < b).sum() for b in bins])
        near = y[before < qr.SHARE * len(y)]
        center = near.mean(axis=0)
        cov = (near.T @ near / len(near) - np.outer(center, center)) * qr.CONSISTENCY
        factor = np.linalg.cholesky(cov + np.diag(floors ** 2))
    want = dict(zip(ids, dist()))
    assert all(abs(got[i] - v) <= 0.02 * (1 + v) for i, v in want.items())


def test_keep_good_keeps_columns(spark):
    rows = fixture()
    d = docs(spark, rows).withColumn("x0", F.lit("clash")).withColumn("kept", F.lit(3)).withColumn("doc", F.lit(1.5))
    out = qr.keep_good(d)
    assert out.columns == d.columns
    verdict = {r.doc_id: r.kept for r in qr.verdicts(docs(spark, rows)).collect()}
    assert sorted(r.doc_id for r in out.collect()) == sorted(r[0] for r in rows if verdict[r[0]])
