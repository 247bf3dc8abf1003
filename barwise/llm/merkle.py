"""Merkle manifest of a dataset: a hash tree for each group of rows and one over the groups.

The rows of a group (a language) are leaves in the order of their ids; two
neighbouring nodes make a parent, and a last node without a neighbour is
hashed alone. The groups' roots, in order of the group, are the leaves of one
more tree, whose root stands for the dataset.

Nodes are kept in a van Emde Boas layout. A tree of h node levels is split at
half height into a top of h // 2 levels and bottom subtrees of the rest; the
top's nodes come first, then each bottom subtree, and every part is laid out
in the same way. Splitting stops at aligned subtrees of at most ``LEVELS``
levels: these are the blocks, one row each, whose nodes are contiguous. A node's
address needs no search: three tables of h numbers give it from its depth and
index (``address``), within a block and, for a block's first node, within the
whole tree (column ``address``, the order in which to store the blocks).

Blocks of the lowest levels are built from the leaves, the next ones from
their roots, until one block is left in each tree; the work shrinks by the
width of a block each time, so there are few rounds. Proofs come back down
the same way: a block hands each block below it the siblings on its way to
the root. Hashes are hexadecimal text throughout: a parent is the SHA-256 of
its children's digests, concatenated.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.llm.scratch import stored
from barwise.llm.sharding import number_rows
from barwise.operators.joins import bounded_broadcast
from barwise.session import checkpoint_root

LEVELS = 9  # node levels of a block at most: 256 leaves
DIGEST = 64
BATCH = 200  # blocks handed over at a time


def node_levels(n: int) -> int:
    """Levels of nodes of the tree over n leaves."""
    return max(n - 1, 0).bit_length() + 1


def cuts(levels: int, most: int) -> list[int]:
    """Node levels of the blocks on a path from a leaf to the root: halves, halved until they fit."""
    if levels <= most:
        return [levels]
    top = levels // 2
    return cuts(levels - top, most) + cuts(top, most)


@lru_cache(maxsize=None)
def _layout(levels: int) -> tuple[tuple[int, int, int], ...]:
    """For each depth below the first: depth of the root of the top part that ends
    above it, nodes of that top part, nodes of the bottom part that starts there."""
    table: dict[int, tuple[int, int, int]] = {}

    def split(first: int, h: int) -> None:
        if h == 1:
            return
        top = h // 2
        table[first + top] = (first, (1 << top) - 1, (1 << (h - top)) - 1)
        split(first, top)
        split(first + top, h - top)

    split(0, levels)
    return tuple(table[d] for d in range(1, levels))


def address(depth: int, index, levels: int):
    """Place of node ``index`` (a number or an array) of ``depth`` (the root has 0) in the layout of a tree of ``levels``.

    The node's subtree starts where the top part above it starts, plus that
    part's nodes, plus the bottom subtrees to its left: their number is the
    node's index within the top part's next level.
    """
    table = _layout(levels)
    place = index * 0
    while depth:
        root, top, bottom = table[depth - 1]
        place = place + top + (index & top) * bottom
        index, depth = index >> (depth - root), root
    return place


def field(value: Column) -> Column:
    """``-`` for null, else the value's UTF-8 byte count, a colon and the value."""
    v = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c).cast("binary") for c in columns]), 256)


def _parent(children: bytes) -> bytes:
    return sha256(children).hexdigest().encode()


def block_nodes(kids: Sequence[bytes], levels: int, from_leaves: bool) -> list[list[bytes]]:
    """The block's nodes, lowest level first, from its leaves or from the roots of the blocks below."""
    def paired(row: Sequence[bytes]) -> list[bytes]:
        return [_parent(b"".join(row[i:i + 2])) for i in range(0, len(row), 2)]

    rows = [list(kids) if from_leaves else paired(kids)]
    for _ in range(levels - 1):
        rows.append(paired(rows[-1]))
    return rows


def pack(rows: list[list[bytes]], levels: int) -> bytes:
    """The block's nodes in their layout; places without a node are zero bytes."""
    out = np.zeros(((1 << levels) - 1, DIGEST), np.uint8)
    for k, row in enumerate(rows):
        at = address(levels - 1 - k, np.arange(len(row)), levels)
        out[at] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, DIGEST)
    return out.tobytes()


def unpack(nodes: bytes, levels: int) -> list[list[bytes | None]]:
    """Level by level, lowest first: the nodes at their indexes, None where there is none."""
    rows = []
    for k in range(levels):
        places = address(levels - 1 - k, np.arange(1 << (levels - 1 - k)), levels) * DIGEST
        row = [nodes[p:p + DIGEST] for p in places.tolist()]
        rows.append([x if x[0] else None for x in row])
    return rows


@dataclass
class Manifest:
    """The blocks of each round, lowest first, and the roots.

    ``rounds``: tables of tree, n (leaves), round, block, levels, address,
    nodes, root, kids (roots of the blocks below; null in the first round)
    and, in the first round, rows (the leaves' rows in order).
    ``roots``: a row for each tree: tree, n, subroot.
    """

    rounds: list[DataFrame]
    roots: DataFrame
    most: int = LEVELS

    def blocks(self) -> DataFrame:
        """All blocks without their rows."""
        out = self.rounds[0].drop("rows")
        for r in self.rounds[1:]:
            out = out.unionByName(r)
        return out


_BLOCK = "tree string, n long, round int, block long, levels int, address long, nodes binary, root string, kids array<string>"


def _built(grouped: DataFrame, done: int, most: int) -> DataFrame:
    """Blocks of round ``done`` from tree, n, block and ``rows`` (first round) or ``kids``, in order."""
    schema = _BLOCK if done else f"{_BLOCK}, rows {grouped.schema['rows'].dataType.simpleString()}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                b = whole.slice(at, BATCH)
                made = []
                for r, (n, block) in enumerate(zip(b.column("n").to_pylist(), b.column("block").to_pylist())):
                    if done:
                        kids = b.column("kids")[r].as_py()
                    else:
                        kids = pc.struct_field(b.column("rows").slice(r, 1).flatten(), "digest").to_pylist()
                    total = node_levels(n)
                    path = cuts(total, most)
                    h, below = path[done], sum(path[:done])
                    rows = block_nodes([k.encode() for k in kids], h, done == 0)
                    made.append((h, int(address(total - below - h, block, total)), pack(rows, h), rows[-1][0].decode(), kids if done else None))
                types = (pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.list_(pa.string()))
                out = [b.column("tree"), b.column("n"), pa.array([done] * b.num_rows, pa.int32()), b.column("block"),
                       *(pa.array(o, t) for o, t in zip(zip(*made), types))]
                names = ["tree", "n", "round", "block", "levels", "address", "nodes", "root", "kids"]
                yield pa.RecordBatch.from_arrays(out if done else [*out, b.column("rows")], names=names if done else [*names, "rows"])

    return grouped.mapInArrow(run, schema)


def _bits(n: Column, done: int, most: int) -> Column:
    """Bits of a child's index that lie inside its block of round ``done``; null where a tree of n leaves has fewer rounds.

    A child is a leaf in the first round, then a root of a block of the round before.
    """
    out = F
    for levels in range(1, 64):
        path = cuts(levels, most)
        bits = path[done] - (done == 0) if len(path) > done else None
        out = out.when(n <= F.lit(2 ** (levels - 1)), F.lit(bits).cast("int"))
    return out


def _block_of(index: str, bits: Column) -> Column:
    return F.call_function("shiftright", F.col(index), bits)


def build(leaves: DataFrame, most: int = LEVELS) -> Manifest:
    """The forest over ``leaves``: tree, pos (0, 1, ... within the tree), n (leaves of the tree), digest, and any further columns.

    A block has at most ``most`` node levels (2 ** (most - 1) leaves), so no task gathers a whole
    tree, however many rows one tree has. Each round is written to the scratch
    folder.
    """
    extra = [c for c in leaves.columns if c not in ("tree", "pos", "n", "digest")]
    first = leaves.withColumn("block", _block_of("pos", _bits(F.col("n"), 0, most)))
    rows = F.array_sort(F.collect_list(F.struct("pos", "digest", *extra)))  # at most a block's leaves
    rounds = [stored(_built(first.groupBy("tree", "n", "block").agg(rows.alias("rows")), 0, most), "merkle-blocks")]
    while True:
        done = len(rounds)
        up = rounds[-1].select("tree", "n", "block", "root", _bits(F.col("n"), done, most).alias("bits")).filter("bits is not null")
        if up.isEmpty():
            break
        kids = F.transform(F.array_sort(F.collect_list(F.struct("block", "root"))), lambda k: k["root"])
        up = up.groupBy("tree", "n", _block_of("block", F.col("bits")).alias("parent")).agg(kids.alias("kids"))
        rounds.append(stored(_built(up.withColumnRenamed("parent", "block"), done, most), "merkle-blocks"))
    roots = None
    for done, r in enumerate(rounds):
        top = _tops(r, done, most).select("tree", "n", F.col("root").alias("subroot"))
        roots = top if roots is None else roots.unionByName(top)
    return Manifest(rounds, roots, most)


def _tops(blocks: DataFrame, done: int, most: int) -> DataFrame:
    """The blocks of round ``done`` that hold a tree's root."""
    return blocks.filter(_bits(F.col("n"), done + 1, most).isNull())


# A step of a proof: the sibling and whether it is on the left; null where the node is hashed alone.
STEP = "array<struct<left:boolean,digest:string>>"


def _steps(index: int, rows: list[list[bytes | None]], upto: int) -> list[tuple[bool | None, str | None]]:
    """Siblings of ``index`` in the first ``upto`` of the block's levels."""
    out = []
    for k in range(upto):
        i = index >> k
        other = rows[k][i ^ 1] if i ^ 1 < len(rows[k]) else None
        out.append((None, None) if other is None else (bool(i & 1), other.decode()))
    return out


def proofs(manifest: Manifest, above: DataFrame) -> DataFrame:
    """tree, n, pos, steps and the further columns of the leaves: the way from each leaf to the root.

    ``above``: tree, steps: what follows the tree's own root (for a tree of its own, no step).
    """
    above = above.select(F.col("tree").alias("_tree"), "steps")
    paths = None  # tree, block, steps: from the root of a block of this round upwards
    for done in range(len(manifest.rounds) - 1, -1, -1):
        blocks = manifest.rounds[done]
        last = _tops(blocks, done, manifest.most).select("tree", "block").join(above, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")
        paths = last if paths is None else paths.unionByName(last)
        at = paths.select(F.col("tree").alias("_tree"), F.col("block").alias("_block"), "steps")
        blocks = blocks.join(at, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("block") == F.col("_block")))
        if done:
            paths = stored(_handed_down(blocks), "merkle-paths")
    return _leaf_paths(blocks)


def _handed_down(blocks: DataFrame) -> DataFrame:
    """tree, block, steps for each block below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, block, h, nodes, kids, steps in zip(*(b.column(c).to_pylist() for c in ("tree", "block", "levels", "nodes", "kids", "steps"))):
                rows = unpack(nodes, h)
                after = [(s["left"], s["digest"]) for s in steps]
                ways = []
                for i in range(len(kids)):
                    other = kids[i ^ 1] if i ^ 1 < len(kids) else None
                    ways.append([(None, None) if other is None else (bool(i & 1), other), *_steps(i >> 1, rows, h - 1), *after])
                base = block << h
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(kids), pa.string()), pa.array([base + i for i in range(len(kids))], pa.int64()), _step_array(ways)],
                    names=["tree", "block", "steps"])

    return blocks.select("tree", "block", "levels", "nodes", "kids", "steps").mapInArrow(run, f"tree string, block long, steps {STEP}")


def _step_array(ways: list[list[tuple[bool | None, str | None]]]) -> pa.Array:
    flat = [s for w in ways for s in w]
    ends = np.cumsum([0, *map(len, ways)]).astype(np.int32)
    steps = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.bool_()), pa.array([s[1] for s in flat], pa.string())], names=["left", "digest"])
    return pa.ListArray.from_arrays(pa.array(ends), steps)


def _leaf_paths(blocks: DataFrame) -> DataFrame:
    rows_type = blocks.schema["rows"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                tree, n, h, nodes, steps = (b.column(c)[r].as_py() for c in ("tree", "n", "levels", "nodes", "steps"))
                held = b.column("rows").slice(r, 1).flatten()
                rows = unpack(nodes, h)
                after = [(s["left"], s["digest"]) for s in steps]
                ways = [_steps(i, rows, h - 1) + after for i in range(len(held))]
                yield pa.RecordBatch.from_arrays([pa.array([tree] * len(held), pa.string()), pa.array([n] * len(held), pa.int64()),
                                                  _step_array(ways), held], names=["tree", "n", "steps", "row"])

    out = blocks.select("tree", "n", "levels", "nodes", "steps", "rows").mapInArrow(
        run, f"tree string, n long, steps {STEP}, row {rows_type.simpleString()}")
    return out.select("tree", "n", "steps", "row.*")


def fold(digest: Column, steps: Column) -> Column:
    """The root that ``digest`` and the siblings on its way give."""
    return F.aggregate(steps, digest, lambda a, s: F.sha2(F.when(s["digest"].isNull(), a).when(s["left"], F.concat(s["digest"], a))
                                                          .otherwise(F.concat(a, s["digest"])), 256))


def placed(leaves: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``leaves`` with pos (its place within ``tree`` in the order of ``keys``) and n (the rows of the tree).

    Rows are numbered over key ranges of all trees, so a tree that holds a
    third of the rows spans many tasks; a tree's start is its least number.
    """
    spark = leaves.sparkSession
    checkpoint_root(spark)
    numbered, _ = number_rows(leaves, ["tree", *keys], "_row")
    trees = numbered.groupBy("tree").agg(F.min("_row").alias("_start"), F.count(F.lit(1)).alias("n"))
    trees = stored(trees, "merkle-trees").withColumnRenamed("tree", "_tree")
    out = numbered.join(bounded_broadcast(trees), F.col("tree").eqNullSafe(F.col("_tree")))
    return out.withColumn("pos", F.col("_row") - F.col("_start")).drop("_row", "_start", "_tree")


@dataclass
class Dataset:
    """The forest of the groups, the tree over their roots, and the root (a table of one row; none without rows)."""

    forest: Manifest
    top: Manifest

    def root(self) -> DataFrame:
        return self.top.roots.select(F.col("subroot").alias("root"))

    def proofs(self) -> DataFrame:
        """tree, n, steps and the leaves' columns, from each leaf to the dataset's root."""
        start = self.top.roots.select("tree", F.array().cast(STEP).alias("steps"))
        above = proofs(self.top, start).select(F.col("group").alias("tree"), "steps")
        return proofs(self.forest, above)


def manifest(leaves: DataFrame, keys: Sequence[str], most: int = LEVELS) -> Dataset:
    """Hash trees over ``leaves`` (tree, digest, the ``keys`` and any further columns).

    A null tree is a group of its own, before the others; groups are in
    order of their bytes. Null keys come first; rows equal in all keys are
    in order of their digest, and equal rows are leaves of their own.
    """
    forest = build(placed(leaves, [*keys, "digest"]), most)
    groups = forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("digest"))
    return Dataset(forest, build(placed(groups, ["group"]), most))


def tampered(doc_id: Column, n_chars: Column) -> Column:
    """n_chars as an intruder leaves it: one more where 7 divides the crc32 of the id's digits."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    return F.when(hit, n_chars + 1).otherwise(n_chars)


def verify(docs: DataFrame, most: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row for each row of ``docs``.

    The manifest is built from the rows as they are (doc_id, source, lang,
    n_chars, text); then each row, tampered with or not, is folded with its
    siblings. A null id is not tampered with and comes first in its language.
    An empty table gives no rows. Other columns are not read.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"), F.col("text").cast("string").alias("text"))
    values = lambda n_chars: [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    changed = tampered(F.col("doc_id"), F.col("n_chars"))
    differs = ~changed.eqNullSafe(F.col("n_chars"))
    leaves = d.select(F.col("lang").alias("tree"), "doc_id", leaf(values(F.col("n_chars"))).alias("digest"),
                      F.when(differs, leaf(values(changed))).alias("presented"))
    data = manifest(leaves, ["doc_id"], most)
    root = (data.root().first() or [None])[0]
    roots = data.forest.roots.select(F.col("tree").alias("_tree"), "subroot")
    rows = data.proofs()
    rows = rows.join(bounded_broadcast(roots), F.col("tree").eqNullSafe(F.col("_tree")))
    folded = fold(F.coalesce("presented", "digest"), F.col("steps"))
    seen = F.sha2(F.array_join(F.col("steps.digest"), ""), 256)
    return rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root).cast("string").alias("root"), seen.alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
