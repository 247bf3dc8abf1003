import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwise.llm import merkle as mk

from .helpers import DOC, docs, odd_texts, prose

COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[c] for c in ("doc_id", "source", "lang", "n_chars", "text"))])


def tree(leaves):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([H(*rows[-1][i:i + 2]) for i in range(0, len(rows[-1]), 2)])
    return rows


def way(rows, i):
    out = []
    for row in rows[:-1]:
        out.append((i & 1, row[i ^ 1]) if i ^ 1 < len(row) else None)
        i >>= 1
    return out


def climb(digest, steps):
    for s in steps:
        digest = H(digest) if s is None else H(s[1], digest) if s[0] else H(digest, s[1])
    return digest


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in order}
    top = tree([trees[g][-1][0] for g in order]) if order else None
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(groups[g]):
            steps = way(trees[g], i) + way(top, k)
            shown = dict(r)
            if None not in (r["doc_id"], r["n_chars"]) and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0:
                shown["n_chars"] += 1
            folded, root = climb(leaf(shown), steps), top[-1][0]
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], root, H(*[s[1] for s in steps if s]), folded, folded == root))
    return sorted(out, key=str)


def check(df, most=mk.LEVELS):
    got = sorted((tuple(r[c] for c in COLS) for r in mk.verify(df, most).collect()), key=str)
    assert got == brute([r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    return got


@pytest.mark.parametrize("levels", range(1, 14))
def test_layout_is_recursive_halving(levels):
    """Addresses against nodes listed by the definition: the top half, then each bottom subtree."""
    def listed(depth, index, h):
        if h == 1:
            return [(depth, index)]
        top = h // 2
        out = listed(depth, index, top)
        for k in range(1 << top):
            out += listed(depth + top, (index << top) + k, h - top)
        return out

    nodes = listed(0, 0, levels)
    assert [mk.address(d, i, levels) for d, i in nodes] == list(range((1 << levels) - 1))
    d = levels - 1
    at = mk.address(d, np.arange(1 << d), levels)
    assert at.tolist() == [mk.address(d, i, levels) for i in range(1 << d)]


def test_blocks_lie_whole_in_the_layout_of_the_tree():
    for total in (10, 17, 18, 25, 37):
        path = mk.cuts(total, mk.LEVELS)
        assert sum(path) == total and max(path) <= mk.LEVELS
        below = 0
        for h in path:
            root_depth = total - below - h
            for block in (0, 1, (1 << root_depth) - 1):
                if block >> root_depth:
                    continue
                base = mk.address(root_depth, block, total)
                for d in range(h):
                    for i in (0, (1 << d) - 1):
                        assert mk.address(root_depth + d, (block << d) + i, total) == base + mk.address(d, i, h)
            below += h


def test_pack_and_unpack_of_partial_blocks():
    for n in (1, 2, 3, 5, 8):
        rows = mk.block_nodes([H(str(i)).encode() for i in range(n)], 5, True)
        back = mk.unpack(mk.pack(rows, 5), 5)
        assert [[x for x in r if x] for r in back] == rows


@pytest.mark.parametrize("n", [1, 2, 3, 5, 255, 256, 257, 700])
def test_trees_of_many_sizes(spark, n):
    rng = random.Random(n)
    rows = [(i * 3, prose(rng, 5), "one") for i in range(n)] + [(7, "x", "two"), (9, "y", "zwei"), (5, "z", "Two")]
    check(docs(spark, rows))


def test_more_rounds_than_one(spark):
    """Blocks of two levels: many rounds and partial blocks at every one."""
    check(docs(spark, [(i, f"t{i}", f"l{i % 3 if i % 5 else 0}") for i in range(75)]), most=2)


def test_nulls_odd_texts_and_repeated_rows(spark):
    rows = [(i, t, "en", "s", 3) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", "en", "s", 1), (None, None, None, None, None), (None, None, None, None, None), (3, "a", None, None, None), (-4, "a", "", "", 0)]
    rows += [(77, "same", "en", "s", 4)] * 9 + [(77, "other", "en", "s", 5)] * 2 + [(8, "ü", "ü", "s", 1), (9, "z", "z", "s", 1), (10, "z", "Z", "s", 1)]
    got = check(spark.createDataFrame([(r[0], r[1], r[2], r[3], r[4]) for r in rows], DOC).repartition(5))
    assert len(got) == len(rows) and {g[-1] for g in got} == {True, False}


def test_empty_table_and_clashing_columns(spark):
    assert mk.verify(docs(spark, [])).collect() == []
    d = docs(spark, [(i, f"t{i}", "en") for i in range(20)])
    extra = d.withColumn("tree", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("root", F.lit("r")).withColumn("n", F.lit(2)).withColumn("digest", F.lit(""))
    assert sorted(map(str, mk.verify(extra).collect())) == sorted(map(str, mk.verify(d).collect()))


def test_manifest_keeps_every_node_once(spark):
    leaves = spark.range(600).select(F.lit("t").alias("tree"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.col("id").alias("doc_id"))
    data = mk.manifest(leaves, ["doc_id"])
    want = tree([H(str(i)) for i in range(600)])
    total, found = len(want), {}
    for r in data.forest.blocks().collect():
        for p in range((1 << r["levels"]) - 1):
            x = r["nodes"][p * mk.DIGEST:(p + 1) * mk.DIGEST]
            if x[0]:
                found[r["address"] + p] = x.decode()
    assert found == {mk.address(total - 1 - k, i, total): x for k, row in enumerate(want) for i, x in enumerate(row)}
    assert data.root().first().root == want[-1][0]
