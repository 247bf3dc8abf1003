"""Near-duplicate classes: SetSketch bands, joint likelihood estimates, exact checks.

1. Every text's distinct word shingles give a set key (128-bit digest of the
   sorted hashes) and SetSketch registers. Texts with one set key are one
   class and one node, however many rows and ids it has; copies never meet.
2. Bands of register values are hashed to buckets. At similarity 0.8 a pair
   shares none of the 40 bands of 5 with probability 1.2e-7.
3. Members of a bucket are compared by likelihood estimate with its hub, the
   member that meets most others (in a group of copies, the one they vary). In
   buckets that this leaves in several parts, all members are compared.
   Estimates five standard deviations below the threshold are no candidates;
   connected candidates make a cluster.
4. Within each cluster all pairs are checked on the full sets, and the links
   that hold make the components.

Comparisons of steps 3 and 4 run in blocks: a bucket or cluster of more than
``BLOCK`` members (or more set bytes than ``BLOCK_SHINGLES``) is dealt over
pairs of blocks, so a task holds two blocks, and each block pair returns a
spanning forest of what it found, never its pairs. Ids, registers and bands
are shuffled to find candidates; full sets are rebuilt for cluster members
alone, whose keys are broadcast to the texts up to ``SENT_BYTES`` (beyond that
the texts are shuffled to the keys). Intermediate tables are written to the
shared scratch folder and removed when nothing reads them any more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.llm import setsketch as ss
from barwise.llm.scratch import forget, stored
from barwise.llm.words import text_parts
from barwise.operators.joins import bounded_broadcast

BANDS, ROWS = 40, 5
PART_BYTES = 1 << 20
# Five standard deviations of the estimate (256 registers) below the threshold.
MARGIN = 0.125
# Members, and shingles of members, in a block; columns of one matrix product.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 2_000_000, 4096
# Stored keys of this size at most are broadcast to the texts; beyond, the texts are shuffled to them.
SENT_BYTES = 24 << 20


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, key (null for an empty set), regs, mark (of the text)."""
    schema = "doc_id long, n_shingles long, key binary, regs binary, mark long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_parts(b.column(1), PART_BYTES):
                elements, at = ss.shingle_sets(data, offs, shingle)
                regs = ss.registers(elements, at)
                n = np.diff(at)
                keys = [hashlib.blake2b(elements[x:y].tobytes(), digest_size=16).digest() if y > x else None
                        for x, y in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), pa.array(keys, pa.binary()),
                     pa.array([r.tobytes() for r in regs], pa.binary()), b.column(2).slice(i, j - i)],
                    names=["doc_id", "n_shingles", "key", "regs", "mark"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text")).mapInArrow(run, schema)


def sets(docs: DataFrame, shingle: int) -> DataFrame:
    """node, els: the full shingle sets of ``docs`` (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_parts(b.column(1), PART_BYTES):
                elements, at = ss.shingle_sets(data, offs, shingle)
                els = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), els], names=["node", "els"])

    return docs.select("node", "text").mapInArrow(run, "node long, els array<long>")


def buckets(classes: DataFrame) -> DataFrame:
    """bucket, node: a row for each band of each class."""
    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", 1 + i * width, width)) for i in range(BANDS)])
    return classes.select(F.explode(keys).alias("bucket"), F.col("rep").alias("node"))


def _grouped(rows: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """``rows`` grouped by the long ``key``, to be joined with rows of that key.

    Grouped by the key's complement, the result is not yet dealt by the key, so the join
    exchanges both sides anew: only then can Spark split the rows of a hot key over tasks
    (skew join), or send a small result to all of them instead.
    """
    names = rows.groupBy(F.bitwise_not(key).alias("_key")).agg(*aggs)
    return names.select(F.bitwise_not("_key").alias(key), *names.columns[1:])


def _little_endian(col: str) -> Column:
    """A long as eight bytes, lowest first."""
    digits = F.lpad(F.hex(col), 16, "0")
    return F.unhex(F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)]))


def candidates(spokes: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The spokes (hub, node) as edges (u, v) whose estimate is not far below the threshold."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n_shingles").alias("n" + x), F.col("regs").alias("r" + x))
    both = spokes.join(side("node"), "node").join(side("hub"), "hub")
    both = both.filter(100 * F.least("nhub", "nnode") >= percent * F.greatest("nhub", "nnode"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                c = b.slice(at, 2000)
                regs = [np.frombuffer(b"".join(c.column(k).to_pylist()), np.uint16).reshape(c.num_rows, -1) for k in (4, 5)]
                n = [c.column(k).to_numpy().astype(float) for k in (2, 3)]
                ok = pa.array(ss.similarity(*regs, *n) >= percent / 100 - MARGIN)
                yield pa.RecordBatch.from_arrays([c.column(0), c.column(1)], names=["u", "v"]).filter(ok)

    return both.select("hub", "node", "nhub", "nnode", "rhub", "rnode").mapInArrow(run, "u long, v long")


def _dealt(members: DataFrame, group: str, size: DataFrame) -> DataFrame:
    """``members`` with ``g``: one row for each block pair of its group that the member is in.

    ``size``: group, blocks. A member's block is a hash of its node.
    """
    at = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    rows = members.join(size, group).withColumn("at", at).withColumn("other", other)
    rows = rows.filter((F.col("blocks") == 1) | (F.col("at") != F.col("other")))
    return rows.withColumn("g", F.xxhash64(group, F.least("at", "other"), F.greatest("at", "other"))).drop("at", "other", "blocks")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Runs of equal first column, as slices of the batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        g = b.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
        for x, y in zip(cuts[:-1], cuts[1:]):
            if held and g[x] != last:
                yield held
                held = []
            last = g[x]
            held.append(b.slice(x, y - x))
    if held:
        yield held


def _forest(nodes: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (u, v) from each node to the first one of its part under the relation ``near``."""
    n = len(nodes)
    near = near | near.T
    np.fill_diagonal(near, True)
    label = np.arange(n)
    while True:
        low = np.where(near, label[None, :], n).min(axis=1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    far = label != np.arange(n)
    return nodes[label[far]], nodes[far]


def _edges(rows: DataFrame, relation) -> DataFrame:
    """u, v: forests of the groups of ``rows`` (g, node, payload) under ``relation(payload arrays) -> bool matrix``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for group in _groups(batches):
            nodes = np.concatenate([b.column(1).to_numpy() for b in group])
            if len(nodes) > 1:
                out.append(_forest(nodes, relation([b.column(2) for b in group])))
            if sum(len(u) for u, _ in out) > 50_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return rows.repartition("g").sortWithinPartitions("g").mapInArrow(run, "u long, v long")


def _batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _estimated(percent: int):
    """Relation: the estimate of two sketches (set size before the registers) is not far below the threshold."""
    def relation(cols: list[pa.Array]) -> np.ndarray:
        raw = np.frombuffer(b"".join(x for c in cols for x in c.to_pylist()), np.uint8).reshape(-1, 8 + 2 * ss.REGISTERS)
        n = raw[:, :8].copy().view(np.int64)[:, 0].astype(float)
        regs = raw[:, 8:].copy().view(np.uint16)
        out = np.zeros((len(n), len(n)), bool)
        for i in range(len(n) - 1):
            fits = 100 * np.minimum(n[i], n[i + 1:]) >= percent * np.maximum(n[i], n[i + 1:])
            j = i + 1 + np.flatnonzero(fits)
            if len(j):
                out[i, j] = ss.similarity(regs[j], regs[i:i + 1], n[j], n[i:i + 1]) >= percent / 100 - MARGIN
        return out

    return relation


def _exact(percent: int):
    """Relation: 100 * |common| >= percent * |all|, from products of the 0/1 matrices of shared shingles."""
    def relation(cols: list[pa.Array]) -> np.ndarray:
        sizes = np.concatenate([pc.list_value_length(c).to_numpy() for c in cols])
        values = np.concatenate([c.flatten().to_numpy() for c in cols])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        first = np.concatenate(([True], values[1:] != values[:-1]))
        column = np.cumsum(first) - 1
        shared = np.bincount(column)[column] > 1
        _, column = np.unique(column[shared], return_inverse=True)
        owner = owner[shared]
        common = np.zeros((len(sizes), len(sizes)), np.float64)
        ends = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + COLUMNS, COLUMNS))
        for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            m = np.zeros((len(sizes), min(COLUMNS, int(column[-1]) + 1 - k * COLUMNS)), np.float32)
            m[owner[a:b], column[a:b] - k * COLUMNS] = 1
            common += m @ m.T
        whole = sizes[:, None] + sizes[None, :] - common
        return (100 * common >= percent * whole) & (sizes > 0)[:, None]

    return relation


def components(links: DataFrame) -> DataFrame:
    """node, comp for all nodes of ``links`` (u, v): the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes; the
    number of steps grows with the logarithm of a component's size.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("x"), F.least("u", "v").alias("y")).filter("x <> y").distinct(), "links")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first())
    was = mark(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = _grouped(both, "x", F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        # Large star: larger neighbours to the smallest of the neighbourhood.
        large = both.filter("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).distinct()
        # Small star: smaller neighbours and the node itself to the smallest.
        least = _grouped(large, "x", F.min("y").alias("m"))
        small = large.join(least, "x")
        small = small.filter("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(
            least.select("x", F.col("m").alias("y"))).distinct()
        last, edges = edges, stored(small, "links")
        forget(last)
        now = mark(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("x").alias("node"), F.col("y").alias("comp")).unionByName(
        edges.select(F.col("y").alias("node"), F.col("y").alias("comp")).distinct())


def _same_row(mark: str, other_mark: str, doc_id: str, other_id: str) -> Column:
    """Equal marks and ids, null ids being equal. The mark alone is the join's key: a
    broadcast table over one long takes a fraction of the memory of one over two columns."""
    a, b = F.col(doc_id), F.col(other_id)
    return (F.col(mark) == F.col(other_mark)) & F.coalesce(a.bitwiseXOR(b) == 0, a.isNull() & b.isNull())


def _classified(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, key, mark, component_id (null without any id), group: a row per document."""
    sketched = stored(sketch(docs, shingle), "sketch")
    reps = sketched.filter("n_shingles > 0").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("regs").alias("regs"))
    # A class's node is its smallest id; where another class has that too, or there is none, a hash of its key.
    # Of the classes that share an id the one of the least key keeps it (a grouped minimum, however many they are).
    found = stored(reps, "reps")
    shared = found.filter("rep is not null").groupBy(F.col("rep").alias("_rep")).agg(F.min("key").alias("owner"), F.count(F.lit(1)).alias("k"))
    shared = stored(shared.filter("k > 1").drop("k"), "shared")
    keeps = F.col("rep").isNotNull() & F.coalesce(F.col("owner") == F.col("key"), F.lit(True))
    reps = found.join(bounded_broadcast(shared, SENT_BYTES), F.col("rep") == F.col("_rep"), "left")
    reps = stored(reps.withColumn("node", F.when(keeps, F.col("rep")).otherwise(F.xxhash64("key"))).drop("_rep", "owner"), "classes")
    forget(found)
    classes = reps.select(F.col("node").alias("rep"), "n_shingles", "regs")

    # Members of buckets with two nodes or more, and the size of their bucket.
    banded = buckets(classes)
    full = _grouped(banded, "bucket", F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("k"))
    members = stored(banded.join(full.filter("low < high").select("bucket", "k"), "bucket"), "members")

    # Step 3: each member against the hub of its buckets, then what is left in parts.
    met = members.groupBy("node").agg(F.sum("k").alias("met"))
    hubs = _grouped(members.join(met, "node"), "bucket", F.max(F.struct("met", (-F.col("node")).alias("n"))).alias("h"))
    spokes = members.join(hubs.select("bucket", (-F.col("h.n")).alias("hub")), "bucket").filter("node <> hub").select("hub", "node").distinct()
    near = components(stored(candidates(spokes, classes, percent), "candidates"))
    parts = members.join(near, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = _grouped(parts, "bucket", F.min("comp").alias("a"), F.max("comp").alias("b"), F.count(F.lit(1)).alias("k")).filter("a < b")
    mixed = mixed.select("bucket", F.ceil(F.col("k") / BLOCK).alias("blocks"))
    payload = F.concat(_little_endian("n_shingles"), "regs").alias("payload")
    rest = _dealt(members.select("bucket", "node"), "bucket", mixed).select("g", "node")
    rest = rest.join(classes.select(F.col("rep").alias("node"), payload), "node").select("g", "node", "payload")
    more = stored(_edges(rest, _estimated(percent)).distinct(), "candidates")
    clusters = stored(components(near.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(more)), "clusters")

    # Step 4: all pairs of a cluster on the full sets.
    weighed = clusters.join(classes.select(F.col("rep").alias("node"), "n_shingles"), "node")
    size = _grouped(weighed, "comp", F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("blocks"))
    # One row of each class gives its set. Texts stay where they are while the wanted rows are few enough to be sent to them.
    one = stored(reps.join(clusters.select("node"), "node", "left_semi").select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark")), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")).alias("d")
    rows = texts.join(bounded_broadcast(one, SENT_BYTES).alias("o"), _same_row("d.mark", "o.mark", "d.doc_id", "o.doc_id"))
    rows = rows.select("o.node", "d.text").groupBy("node").agg(F.min("text").alias("text"))
    full_sets = sets(rows, shingle)
    checked = _dealt(clusters, "comp", size).select("g", "node").join(full_sets, "node").select("g", "node", "els")
    comps = components(stored(_edges(checked, _exact(percent)).distinct(), "links"))
    forget(members, clusters, one)

    placed = reps.join(comps, "node", "left").select("key", "rep", F.coalesce("comp", "node").alias("group"))
    least = placed.groupBy("group").agg(F.min("rep").alias("component"))
    placed = placed.join(least, "group").select("key", "group", "component")
    out = sketched.drop("regs").join(placed, "key", "left")
    return out.select("doc_id", "n_shingles", "key", "mark", "group", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def classify(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, key: one row per document.

    Two documents are linked if 100 * |common shingles| >= percent * |all
    shingles|; component_id is the smallest doc_id reachable, itself included,
    and kept says whether that is the document's own.

    Null, empty and wordless texts have no shingles and are linked with
    nothing. Documents without an id are compared like others but represent
    nothing: component_id is null, and kept true, where none of the component
    has an id. Texts are linked, not ids: rows that repeat an id with
    different texts may be in different components.
    """
    out = _classified(docs, shingle, percent)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "key")


def drop_copies(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each near-duplicate group kept, all columns as they were.

    That is the one with the smallest id; one without an id only where none
    has any. Rows that repeat both id and text are one document: one of them
    stays. Rows without shingles and without an id all stay.
    """
    found = stored(_classified(docs, shingle, percent).filter("key is not null"), "found")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    first = found.groupBy("group").agg(F.min(row).alias("first"))
    gone = found.join(first, "group").filter(~row.eqNullSafe(F.col("first"))).select("doc_id", "mark").distinct()
    bare = stored(found.filter("doc_id is null").select("mark").distinct(), "bare")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.struct(*cols).alias("doc"), F.col("doc_id").cast("long").alias("id"), "text", F.xxhash64("text").alias("mark"))
    # Repeated rows: with an id by id and text, without one only where the text has shingles.
    again = stored(whole.filter("id is not null").groupBy("id").count().filter("count > 1").select("id"), "again")
    if not again.isEmpty():
        again = bounded_broadcast(again, SENT_BYTES)
        once = whole.join(again, "id", "left_semi").dropDuplicates(["id", "text"])
        whole = whole.filter("id is null").unionByName(whole.filter("id is not null").join(again, "id", "left_anti")).unionByName(once)
    if not bare.isEmpty():
        bare = bounded_broadcast(bare, SENT_BYTES)
        nameless = whole.filter("id is null")
        once = nameless.join(bare, "mark", "left_semi").dropDuplicates(["text"])
        whole = whole.filter("id is not null").unionByName(nameless.join(bare, "mark", "left_anti").select(*whole.columns)).unionByName(once.select(*whole.columns))
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")), "gone")
    left = whole.join(bounded_broadcast(gone, SENT_BYTES), _same_row("mark", "gone_mark", "id", "gone_id"), "left_anti")
    return left.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
