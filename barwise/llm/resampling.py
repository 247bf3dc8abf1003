"""Importance resampling towards a target distribution over hashed word n-grams.

Texts of a large raw table are drawn so that the draw looks like a small target
table. Every n-gram falls into one of ``buckets`` buckets by its CRC-32; a
bucket's gain is the logarithm of its share in the target over its share in
the raw table, smoothed by one; a document's weight is the sum of the gains
of its n-grams. Gumbel noise from a hash of the id is added and the highest
scores are drawn, which is sampling without replacement in proportion to the
weights, reproducible and independent of partitions.

Words and n-grams are Arrow columns from end to end: lower-casing, splitting,
flattening and dictionary encoding are Arrow kernels, an n-gram is the pair of
an (n-1)-gram's number and the dictionary index one place on, and only distinct
n-grams of a batch are ever spelled out and hashed. Gains are taken by bucket
and summed over each document's segment.

The texts are read twice (counts, then weights). What is shuffled is one row
per bucket and task, and one slim row per document for the ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.llm.sharding import number_rows

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PART_BYTES = 4 << 20
BUCKETS = 10_000


def parts(texts: pa.Array | pa.ChunkedArray, limit: int = PART_BYTES) -> Iterator[pa.Array]:
    """Slices of at most ``limit`` bytes of text (or one longer text); null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield texts.slice(at, to - at)
        at = to


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(dictionary index of each word, the text it is in, dictionary)."""
    split = pc.split_pattern_regex(pc.ascii_lower(texts), SEPARATORS)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    coded = pc.dictionary_encode(pc.list_flatten(split))
    index = coded.indices.to_numpy(zero_copy_only=False)
    # Before the first and after the last separator there may be an empty piece.
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    real = index != blank
    return index[real].astype(np.int64), owner[real], coded.dictionary


def hashed(texts: pa.Array, max_n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n up to ``max_n``: (bucket of each n-gram, the text it is in)."""
    index, owner, dictionary = words(texts)
    spelled = [w.encode() for w in dictionary.to_pylist()]
    gram, grams = index, spelled
    for n in range(1, max_n + 1):
        if n > 1:
            # The (n-1)-gram at a place and the word n - 1 places on, within one text.
            same = owner[: len(owner) - n + 1] == owner[n - 1:]
            pairs = gram[: len(same)] * len(spelled) + index[n - 1:]
            distinct, inverse = np.unique(pairs[same], return_inverse=True)
            grams = [grams[p // len(spelled)] + b" " + spelled[p % len(spelled)] for p in distinct.tolist()]
            gram = np.full(len(same), -1, np.int64)
            gram[same] = inverse
        crc = np.fromiter((zlib.crc32(g) % buckets for g in grams), np.int64, len(grams))
        whole = gram >= 0
        yield crc[gram[whole]], owner[: len(gram)][whole]


def bucket_counts(df: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """bucket, n of all texts: a row for each bucket of each task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in parts(b.column(0)):
                for at, _ in hashed(part, max_n, buckets):
                    total += np.bincount(at, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    return df.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in ``docs``)) of each bucket, smoothed by one.

    The counts come to the driver: one row a bucket, whatever the size of the tables.
    """
    raw, want = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for df, counts in ((docs, raw), (target, want)):
        for r in bucket_counts(df, max_n, buckets).collect():
            counts[r["bucket"]] = r["n"]
    r_all, w_all = float(raw.sum() + buckets), float(want.sum() + buckets)
    share = [(w + 1.0) * r_all / ((r + 1.0) * w_all) for r, w in zip(raw.tolist(), want.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in share], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_n: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in parts(b.column(1)):
                n_words, n_features, weight = (np.zeros(len(part), np.int64) for _ in range(3))
                for n, (bucket, owner) in enumerate(hashed(part, max_n, len(gain))):
                    found = np.bincount(owner, minlength=len(part))
                    n_words += found if n == 0 else 0
                    n_features += found
                    # Owners ascend: a document's n-grams are one segment.
                    some = np.flatnonzero(found)
                    starts = (np.cumsum(found) - found)[some]
                    if len(some):
                        weight[some] += np.add.reduceat(gain.take(bucket), starts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)), *map(pa.array, (n_words, n_features, weight))],
                                                 names=["doc_id", "n_words", "n_features", "weight"])
                at += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: str) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of sha256('<seed>:<doc_id>'); a null id reads as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = BUCKETS, percent: int = 10,
             min_words: int = 20, seed: str = "2024") -> DataFrame:
    """doc_id, n_features, weight, score, rank: a row for each row of ``docs``.

    Of the documents with ``min_words`` words or more, ``percent`` in a hundred
    (rounded down) are drawn: those of the highest scores, ranked 1, 2, 3, ...;
    of equal scores the smaller id, then the smaller n_features (a null id
    first). The others' rank is null. Null and empty texts have no features and
    weight 0. Repeated rows get equal scores and ranks of their own. An empty
    target counts no n-grams; an empty table gives no rows. Other columns are
    not read.
    """
    scored = weigh(docs, gains(docs, target, max_n, buckets), max_n)
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    ordered = scored.select((F.col("n_words") < min_words).alias("short"), (-F.col("score")).alias("down"),
                            "doc_id", "n_features", "weight", "score")
    placed, _ = number_rows(ordered, ["short", "down", "doc_id", "n_features"], "place")
    n = placed.filter("not short").count()
    rank = F.when(F.col("place") < percent * n // 100, F.col("place") + 1)
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
