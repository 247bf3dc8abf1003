"""Benchmark decontamination by suffix arrays over the training texts.

Each task cuts its documents into shards of bounded size. A shard's words are
written as ranks in the benchmark's vocabulary; words outside it end every
match, so only runs of known words at least as long as the shortest window
can hold one. Over these runs a suffix array is built by prefix doubling. All
benchmark suffixes are then searched in it at once by vectorised binary
search: the first ``window`` words give the block of suffixes (all verbatim
occurrences), and narrowing this block word by word gives the longest match
and its places, and the place of each benchmark suffix in the shard's order;
the suffixes next to it give each document's own longest match.

Documents never move: there is no shuffle. The benchmark is the stated query
set. It is broadcast in blocks whose text is at most ``block_bytes``, checked
before; more blocks mean more passes, whose hits are united per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise.llm.words import ALNUM, text_parts, word_hashes
from barwise.session import checkpoint_root

WINDOW = 10
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20


@dataclass
class Index:
    """Words of the benchmark as vocabulary ranks, and its distinct windows."""

    vocab: np.ndarray  # sorted word hashes
    words: np.ndarray  # ranks of all items' words, end to end
    ends: np.ndarray  # for each word, where its item ends
    items: list  # item id per item
    item_of: np.ndarray  # item number of each word
    sorted: np.ndarray  # windows' places, in the order of the suffixes that begin there
    lcp: np.ndarray  # words that each of them shares with the one before
    starts: np.ndarray  # where each distinct window begins
    lens: np.ndarray  # its words
    group: np.ndarray  # where its places begin in ``sorted``; one more at the end

    def holders(self, c: int) -> np.ndarray:
        """Item numbers holding distinct window c."""
        return np.unique(self.item_of[self.sorted[self.group[c]:self.group[c + 1]]])


def _shared(text: np.ndarray, a: np.ndarray, words: np.ndarray, b: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words that ``text`` from each place a and ``words`` from each place b share, up to b's item end.
    ``text`` ends with a word that is none."""
    n = np.zeros(len(a), np.int64)
    live = np.flatnonzero(b < ends[b]) if len(b) else np.zeros(0, np.int64)
    while len(live):
        same = text[a[live] + n[live]] == words[b[live] + n[live]]
        live = live[same]
        n[live] += 1
        live = live[b[live] + n[live] < ends[b[live]]]
    return n


def build_index(rows: list[tuple], window: int = WINDOW) -> Index:
    """rows: (item_id, text). Null texts and texts without words give no window."""
    texts = pa.array([t for _, t in rows], pa.string())
    parts = [word_hashes(d, o, ALNUM) for _, _, d, o in text_parts(texts, BLOCK_BYTES)]
    hashes = np.concatenate([h for h, _ in parts]) if parts else np.zeros(0, np.uint64)
    counts = np.concatenate([np.diff(c) for _, c in parts]) if parts else np.zeros(0, np.int64)
    vocab, words = np.unique(hashes, return_inverse=True)
    words = words.astype(np.int32)
    item_of = np.repeat(np.arange(len(rows)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    size = np.repeat(counts, counts)
    # All suffixes in order, items parted by a gap; of them those that begin with a window.
    spaced = np.full(len(words) + len(rows), -1, np.int32)
    spaced[np.arange(len(words)) + item_of] = words
    sa = SuffixArray(spaced, 1)
    at = sa.at[sa.order]
    order = at - (np.cumsum(spaced < 0)[at] if len(at) else 0)
    w = np.minimum(window, size)
    order = order[order + w[order] <= ends[order]]
    # An item that is shorter than the window equals no other window, only items of its own length.
    order = order[np.argsort(w[order], kind="stable")]
    closed = np.append(words, np.int32(-1))
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = _shared(closed, order[:-1], words, order[1:], ends)
    lcp[1:] = np.minimum(lcp[1:], ends[order[:-1]] - order[:-1])
    lcp[1:][w[order][1:] != w[order][:-1]] = 0
    first = np.flatnonzero(lcp < w[order])
    return Index(vocab, words, ends, [r[0] for r in rows], item_of, order, lcp, order[first], w[order][first], np.append(first, len(order)))


class SuffixArray:
    """Suffixes of the runs of known words in a shard's texts."""

    def __init__(self, ranks: np.ndarray, shortest: int) -> None:
        """ranks: word ranks of the shard, -1 for unknown words and between texts."""
        n = len(ranks)
        known = ranks >= 0
        edge = np.flatnonzero(np.diff(known.view(np.int8), prepend=0, append=0))
        a, b = edge[::2], edge[1::2]
        long = b - a >= shortest
        a, b = a[long], b[long]
        # The runs end to end, each closed by -1; ``at`` maps back to the shard.
        size = b - a + 1
        shift = np.concatenate([[0], np.cumsum(size)])
        self.at = np.repeat(a - shift[:-1], size) + np.arange(shift[-1])
        self.text = np.append(ranks, -1)[self.at] if n else np.zeros(0, np.int32)
        self.text[shift[1:] - 1] = -1
        left = np.repeat(shift[1:] - 1, size) - np.arange(shift[-1])  # words to the run's end
        rank = (self.text + 1).astype(np.int64)
        k, longest = 1, int(left.max(initial=0))
        while k < longest:
            # Rank by 2k words: the pair of ranks here and k words on.
            follow = np.zeros(len(rank), np.int64)
            if k < len(rank):
                follow[:-k] = rank[k:]
            follow[left <= k] = 0
            _, rank = np.unique(rank * (len(rank) + len(ranks) + int(ranks.max(initial=0)) + 2) + follow, return_inverse=True)
            rank = np.where(left > 0, rank + 1, 0)
            k *= 2
        order = np.argsort(rank, kind="stable")
        self.order = order[left[order] > 0]
        self.text = np.append(self.text, np.int32(-1))

    def _bound(self, words: np.ndarray, starts: np.ndarray, length: int, upper: bool) -> np.ndarray:
        """First place whose first ``length`` words are at least (over, if upper) the query's."""
        lo = np.zeros(len(starts), np.int64)
        hi = np.full(len(starts), len(self.order))
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            pos = self.order[np.minimum(mid, len(self.order) - 1)]
            sign = np.zeros(len(starts), np.int8)
            for t in range(length):
                there, here = self.text[np.minimum(pos + t, len(self.text) - 1)], words[starts + t]
                undecided = sign == 0
                sign[undecided & (there < here)] = -1
                sign[undecided & (there > here)] = 1
            before = (sign < 0) | (upper & (sign == 0))
            lo = np.where(open_ & before, mid + 1, lo)
            hi = np.where(open_ & ~before, mid, hi)
        return lo

    def blocks(self, words: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The half-open block of suffixes that begin with each query's ``length`` words."""
        if not len(self.order) or not len(starts):
            return np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        return self._bound(words, starts, length, False), self._bound(words, starts, length, True)

    def lengthen(self, words: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int,
                 lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Narrow non-empty blocks word by word: longest match, its block, and the query's own place in the order."""
        n = np.full(len(starts), length)
        lo, hi = lo.copy(), hi.copy()
        own = lo.copy()  # of a query that ends inside its block: before it
        live = np.flatnonzero(starts + n < ends[starts])
        while len(live):
            want = words[starts[live] + n[live]]
            cut = []
            for over in (False, True):
                a, b = lo[live].copy(), hi[live].copy()
                while (open_ := a < b).any():
                    mid = (a + b) // 2
                    pos = self.order[np.minimum(mid, len(self.order) - 1)] + n[live]
                    there = self.text[np.minimum(pos, len(self.text) - 1)]
                    before = (there < want) | (over & (there == want))
                    a = np.where(open_ & before, mid + 1, a)
                    b = np.where(open_ & ~before, mid, b)
                cut.append(a)
            own[live] = cut[0]
            more = cut[0] < cut[1]
            live, a, b = live[more], cut[0][more], cut[1][more]
            lo[live], hi[live] = a, b
            n[live] += 1
            live = live[starts[live] + n[live] < ends[starts[live]]]
        return n, lo, hi, own


def _shard(data: np.ndarray, offs: np.ndarray, index: Index) -> tuple[SuffixArray | None, np.ndarray, np.ndarray]:
    """(suffix array, words per text, shard place of each text's first word)."""
    hashes, first = word_hashes(data, offs, ALNUM)
    n = np.diff(first)
    begin = first[:-1] + np.arange(len(n))  # a gap after each text
    if not len(index.starts):
        return None, n, begin
    slot = np.searchsorted(index.vocab, hashes)
    slot[slot == len(index.vocab)] = 0
    ranks = np.full(len(hashes) + len(n), -1, np.int32)
    ranks[np.arange(len(hashes)) + np.repeat(np.arange(len(n)), n)] = np.where(index.vocab[slot] == hashes, slot, -1)
    return SuffixArray(ranks, int(index.lens.min())), n, begin


@dataclass
class Hits:
    """Matches of a shard's texts."""

    flag: np.ndarray  # per shard place, whether a window covers it
    items: dict[int, set]  # item numbers per text with a hit
    longest: dict[int, tuple]  # (words, start word, benchmark place) per text with a hit


def _hits(sa: SuffixArray | None, index: Index, size: int, begin: np.ndarray) -> Hits:
    flag = np.zeros(size + 1, np.int64)
    out = Hits(flag[:-1] > 0, {}, {})
    if sa is None:
        return out
    for w in np.unique(index.lens):
        chosen = np.flatnonzero(index.lens == w)
        lo, hi = sa.blocks(index.words, index.starts[chosen], int(w))
        found = lo < hi
        if not found.any():
            continue
        chosen, lo, hi = chosen[found], lo[found], hi[found]
        for c, a, b in zip(chosen, lo, hi):
            at = sa.at[sa.order[a:b]]
            np.add.at(flag, at, 1)
            np.add.at(flag, at + w, -1)
            held = index.holders(c).tolist()
            for d in np.unique(np.searchsorted(begin, at, side="right") - 1).tolist():
                out.items.setdefault(d, set()).update(held)
        _keep_longest(sa, index, int(w), chosen, lo, hi, begin, out.longest)
    out.flag = np.cumsum(flag)[:-1] > 0
    return out


def _keep_longest(sa: SuffixArray, index: Index, w: int, chosen: np.ndarray, lo: np.ndarray, hi: np.ndarray,
                  begin: np.ndarray, longest: dict[int, tuple]) -> None:
    """The longest match of each text among the blocks of the windows ``chosen``, ties to the first start.

    Every benchmark suffix of these windows is narrowed to its own place among the shard's
    suffixes; a shard suffix shares most with the benchmark suffix before or after it.
    """
    many = index.group[chosen + 1] - index.group[chosen]
    q = index.sorted[np.repeat(index.group[chosen] - np.cumsum(many) + many, many) + np.arange(many.sum())]
    _, _, _, own = sa.lengthen(index.words, index.ends, q, w, np.repeat(lo, many), np.repeat(hi, many))
    by = np.argsort(lo, kind="stable")  # blocks do not overlap, and the suffixes of each are in order
    if (by[1:] < by[:-1]).any():
        edge = np.concatenate([[0], np.cumsum(many)])
        pick = np.concatenate([np.arange(edge[k], edge[k + 1]) for k in by])
        q, own, lo, hi = q[pick], own[pick], lo[by], hi[by]
    wide = hi - lo
    rank = np.repeat(lo - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
    pos = sa.order[rank]
    after = np.searchsorted(own, rank, side="right")
    before, after = np.maximum(after - 1, 0), np.minimum(after, len(q) - 1)
    one, two = (_shared(sa.text, pos, index.words, q[k], index.ends) for k in (before, after))
    n, place = np.maximum(one, two), np.where(one >= two, q[before], q[after])
    at = sa.at[pos]
    d = np.searchsorted(begin, at, side="right") - 1
    order = np.lexsort((at, -n, d))
    first = order[np.unique(d[order], return_index=True)[1]]
    for k in first.tolist():
        got = (-int(n[k]), int(at[k] - begin[d[k]]), int(place[k]))
        longest[int(d[k])] = min(longest.get(int(d[k]), (0,)), got)


def _least_item(index: Index, place: int, n: int, known: dict) -> str | None:
    """The least id, as a string, of the items that hold the n words at a benchmark place; ``known`` keeps answers."""
    passage = index.words[place:place + n].tobytes()
    if passage not in known:
        w = min(n, int(index.lens.max()))
        ids = set()
        for c in np.flatnonzero((index.lens <= w) & (index.words[index.starts] == index.words[place])):
            if (index.words[index.starts[c]:index.starts[c] + index.lens[c]] == index.words[place:place + index.lens[c]]).all():
                for s in index.sorted[index.group[c]:index.group[c + 1]].tolist():
                    if s + n <= index.ends[s] and index.words[s:s + n].tobytes() == passage:
                        ids.add(index.items[index.item_of[s]])
        known[passage] = min((str(i) for i in ids if i is not None), default=None)
    return known[passage]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The query set in blocks of about ``block_bytes`` of text at most, by a hash of the row."""
    b = benchmark.select("item_id", "text").filter("text is not null")
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    for i in range(n):
        part = b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else b
        yield [(r[0], r[1]) for r in part.collect()]


_FOUND = "n_words long, runs array<struct<a:long,b:long>>, items array<string>, has_hit boolean, longest struct<words:long,start:long,item:string>"
_LONGEST = pa.struct([("words", pa.int64()), ("start", pa.int64()), ("item", pa.string())])
_RUN = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _scan(pairs: DataFrame, index_bc, shard_bytes: int) -> DataFrame:
    """pairs: (doc, text). Gives doc, n_words, hit word runs [a, b), item ids as strings, has_hit."""
    schema = T.StructType([pairs.schema["doc"], *T._parse_datatype_string(_FOUND).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = index_bc.value, {}
        for b in batches:
            for i, j, data, offs in text_parts(b.column(1), shard_bytes):
                sa, n, begin = _shard(data, offs, index)
                hits = _hits(sa, index, int(n.sum()) + len(n), begin)
                runs, names, longest = [[] for _ in n], [[] for _ in n], [None] * len(n)
                for d, items in hits.items.items():
                    m, start, place = hits.longest[d]
                    longest[d] = {"words": -m, "start": start, "item": _least_item(index, place, -m, known)}
                    f = hits.flag[begin[d]:begin[d] + n[d]]
                    edge = np.flatnonzero(np.diff(f.view(np.int8), prepend=0, append=0)).tolist()
                    runs[d] = [{"a": x, "b": y} for x, y in zip(edge[::2], edge[1::2])]
                    names[d] = sorted({str(index.items[k]) for k in items if index.items[k] is not None})
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(runs, _RUN),
                     pa.array(names, pa.list_(pa.string())), pa.array([bool(r) for r in runs]), pa.array(longest, _LONGEST)],
                    names=["doc", "n_words", "runs", "items", "has_hit", "longest"])

    return pairs.select("doc", "text").mapInArrow(run, schema)


def find_overlaps(pairs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For ``pairs`` (doc: any payload, text): doc, n_words, runs (hit word
    ranges), items (ids as strings, sorted), has_hit, longest (words, start, item:
    the longest verbatim match of a window or more, the first word of its first place in
    the document, and the least id, as a string, of the items holding it; null without a hit).

    Null and empty texts have no words. An item of fewer words than ``window``
    (but not none) is one window. Items without an id still make words hit,
    but are not listed; an id that repeats is listed once. Repeated documents
    give a row each. Empty tables: no rows, or no hits.
    """
    spark = pairs.sparkSession
    blocks = _blocks(benchmark, block_bytes)
    first = build_index(next(blocks), window)
    second = next(blocks, None)
    if second is None:
        return _scan(pairs, spark.sparkContext.broadcast(first), shard_bytes)
    # Several passes over the same rows, so each row gets a number that stays.
    checkpoint_root(spark)
    fixed = pairs.select("doc", "text").withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    numbered = fixed.select(F.col("_row").alias("doc"), "text")
    parts = _scan(numbered, spark.sparkContext.broadcast(first), shard_bytes)
    while second is not None:
        index = build_index(second, window)
        parts = parts.unionByName(_scan(numbered, spark.sparkContext.broadcast(index), shard_bytes))
        second = next(blocks, None)
    united = parts.groupBy(F.col("doc").alias("_row")).agg(
        F.max("n_words").alias("n_words"), F.sort_array(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.min(F.when(F.col("longest").isNotNull(), F.struct((-F.col("longest.words")).alias("w"), F.col("longest.start").alias("s"),
                                                            F.col("longest.item").isNull().alias("x"), F.col("longest.item").alias("i")))).alias("m"))
    united = united.withColumn("longest", F.when(F.col("m").isNotNull(), F.struct(
        (-F.col("m.w")).alias("words"), F.col("m.s").alias("start"), F.col("m.i").alias("item")))).drop("m")
    # Union of ranges: in order of their starts, extend the last one or begin another.
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate(
        "runs", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)"),
        lambda acc, r: F.when((F.size(acc) > 0) & (r["a"] <= F.try_element_at(acc, F.lit(-1))["b"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(last(acc)["a"].alias("a"),
                                                        F.greatest(last(acc)["b"], r["b"]).alias("b")))))
        .otherwise(F.concat(acc, F.array(r))))
    united = united.withColumn("runs", merged).withColumn("has_hit", F.size("runs") > 0)
    return fixed.select("_row", "doc").join(united, "_row").drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, longest_words (0 without a hit),
    longest_start, longest_item; see ``find_overlaps``."""
    found = find_overlaps(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"), benchmark, **options)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])
    return found.select(F.col("doc").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        F.col("has_hit").alias("contaminated"), "items", F.coalesce("longest.words", F.lit(0)).cast("long").alias("longest_words"),
                        F.col("longest.start").alias("longest_start"), F.col("longest.item").alias("longest_item"))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit word, all columns as they were."""
    pairs = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text"))
    return find_overlaps(pairs, benchmark, **options).filter(~F.col("has_hit")).select("doc.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, words, doc_id, start: each item's longest verbatim match of at
    least ``window`` words (or the whole shorter item), with the smallest
    (doc_id, start word) among the places that reach this length.

    One row per item with a match; per task and item only the best place leaves.
    """
    spark = docs.sparkSession
    schema = "item int, words long, doc_id long, start long"
    out = None
    for rows in _blocks(benchmark, block_bytes):
        index_bc = spark.sparkContext.broadcast(build_index(rows, window))

        def run(batches: Iterator[pa.RecordBatch], index_bc=index_bc) -> Iterator[pa.RecordBatch]:
            index = index_bc.value
            best: dict[int, tuple] = {}
            for b in batches:
                for i, j, data, offs in text_parts(b.column(1), shard_bytes):
                    sa, n, begin = _shard(data, offs, index)
                    if sa is None:
                        continue
                    ids = b.column(0).slice(i, j - i).to_pylist()
                    size = np.bincount(index.item_of, minlength=len(index.items))
                    every = np.arange(len(index.words))
                    every_w = np.minimum(window, size[index.item_of])
                    for w in np.unique(index.lens):
                        q = every[(every_w == w) & (every + w <= index.ends)]
                        lo, hi = sa.blocks(index.words, q, int(w))
                        q, lo, hi = q[lo < hi], lo[lo < hi], hi[lo < hi]
                        length, lo, hi, _ = sa.lengthen(index.words, index.ends, q, int(w), lo, hi)
                        for s, m, x, y in zip(q, length, lo, hi):
                            at = sa.at[sa.order[x:y]]
                            d = np.searchsorted(begin, at, side="right") - 1
                            place = min(((ids[k] is None, ids[k] or 0), int(p - begin[k])) for k, p in zip(d.tolist(), at))
                            item = int(index.item_of[s])
                            best[item] = min(best.get(item, (0,)), (-int(m), *place))
            got = sorted(best.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in got], pa.int32()), pa.array([-v[0] for _, v in got], pa.int64()),
                 pa.array([None if v[1][0] else v[1][1] for _, v in got], pa.int64()), pa.array([v[2] for _, v in got], pa.int64())],
                names=["item", "words", "doc_id", "start"])

        part = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
        names = spark.createDataFrame([(i, str(r[0])) for i, r in enumerate(rows) if r[0] is not None], "item int, item_id string")
        part = part.join(F.broadcast(names), "item")
        out = part if out is None else out.unionByName(part)
    first = F.min(F.struct((-F.col("words")).alias("w"), F.col("doc_id").isNull().alias("x"), "doc_id", "start"))
    return out.groupBy("item_id").agg(first.alias("m")).select("item_id", (-F.col("m.w")).alias("words"), "m.doc_id", "m.start")
