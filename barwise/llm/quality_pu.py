"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled 1; the unlabelled class is web text
without a label. No negative label is used. A first classifier, positives
against unlabelled, gives scores from which the class prior (the share of good
text in the unlabelled class) is estimated: the smallest ratio of unlabelled to
positive mass above a threshold. A small network is then trained on the
non-negative unbiased risk: when the estimated risk on negatives falls below
zero, the step goes up that part instead, which keeps the network from
overfitting the positives.

Features are shares of character classes, word shape and repetition of the
whole text, computed from Arrow buffers. The training sample is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm.langid import fold
from barwise.llm.words import SPACED, text_parts, word_hashes

# The bounded training sample (documented parameters).
POSITIVES, UNLABELLED = 6000, 9000
FOLDS, HELD = 3, 1
HIDDEN, EPOCHS, BATCH, RATE = 16, 60, 512, 0.01
PART_BYTES = 1 << 20

# Byte classes: lower, upper, digit, space, newline, symbol, other ASCII, beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 7
_CLASS[[9, 11, 12, 13, 32]], _CLASS[10] = 3, 4
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 5
N_FEATURES = 12


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers for each text; all zero for an empty one."""
    n = len(offs) - 1
    size = np.diff(offs)
    counts = np.zeros(n * 8, np.int64)
    for a in range(0, len(data), PART_BYTES):
        part = data[a:a + PART_BYTES]
        own = np.searchsorted(offs, np.arange(a, a + len(part)), side="right") - 1
        counts += np.bincount(own * 8 + _CLASS[part], minlength=n * 8)
    counts = counts.reshape(n, 8)
    words, first = word_hashes(data, offs, SPACED)
    n_words = np.diff(first)
    visible = np.maximum(size - counts[:, 3] - counts[:, 4], 1)
    shares = np.sqrt(counts / visible[:, None])[:, [1, 2, 5, 6, 7]]
    distinct, twin = np.zeros(n), np.zeros(n)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a > 1:
            w = words[a:b]
            s = np.sort(w)
            distinct[i] = (1 + np.count_nonzero(s[1:] != s[:-1])) / (b - a)
            twin[i] = np.count_nonzero(w[1:] == w[:-1]) / (b - a - 1)
    length = np.maximum(n_words, 1)
    ups = counts[:, 1] / np.maximum(counts[:, 0] + counts[:, 1], 1)
    out = np.column_stack([shares, ups, np.log(visible / length), np.log1p(n_words) / 5, distinct, np.sqrt(twin),
                           np.sqrt(counts[:, 4] / length), np.sqrt(counts[:, 6] / length)])
    out[n_words == 0] = 0
    return out


@dataclass
class Net:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[0] + self.weights[1])
        return (h @ self.weights[2] + self.weights[3])[:, 0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(pos: np.ndarray, unl: np.ndarray, gradient, seed: int) -> Net:
    """Adam on ``gradient(g of positives, g of unlabelled) -> their gradients``."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.02
    w = [rng.standard_normal((both.shape[1], HIDDEN)) / np.sqrt(both.shape[1]), np.zeros(HIDDEN),
         rng.standard_normal((HIDDEN, 1)) / np.sqrt(HIDDEN), np.zeros(1)]
    m1, m2 = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (pos, unl))
    step = 0
    rounds = max(1, -(-len(u) // BATCH))
    for _ in range(EPOCHS):
        pi, ui = rng.permutation(len(p)), rng.permutation(len(u))
        for part in range(rounds):
            xp, xu = p[pi[part::rounds]] if len(p) >= rounds else p, u[ui[part::rounds]]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ w[0] + w[1])
            g = (h @ w[2] + w[3])[:, 0]
            d = np.concatenate(gradient(g[:len(xp)], g[len(xp):]))[:, None]
            dh = (d @ w[2].T) * (1 - h * h)
            grads = [x.T @ dh + 1e-4 * w[0], dh.sum(axis=0), h.T @ d + 1e-4 * w[2], d.sum(axis=0)]
            step += 1
            for k, gr in enumerate(grads):
                m1[k] = 0.9 * m1[k] + 0.1 * gr
                m2[k] = 0.999 * m2[k] + 0.001 * gr * gr
                w[k] = w[k] - RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)
    return Net(mean, scale, w, 0.5)


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled, from their scores: the smallest
    ratio of unlabelled to positive mass at or above a score that a quarter of the positives reach."""
    cuts = np.quantile(pos, np.linspace(0.0, 0.75, 61))
    mass = lambda s, c: (s[:, None] >= c).mean(axis=0)
    slack = 1 / np.sqrt(max(len(unl), 1))
    return float(np.clip((mass(unl, cuts) / np.maximum(mass(pos, cuts), 1e-9)).min(), slack, 1 - slack))


def train(pos: np.ndarray, unl: np.ndarray, seed: int = 11) -> Net | None:
    """The network of least non-negative unbiased risk; None without positives or unlabelled rows."""
    if not len(pos) or not len(unl):
        return None

    def contrast(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (_sigmoid(gp) - 1) / len(gp), _sigmoid(gu) / len(gu)

    # The prior is read off rows that the contrast classifier has not seen.
    half = lambda x: (x[::2], x[1::2] if len(x) > 1 else x)
    (pa_, pb), (ua, ub) = half(pos), half(unl)
    contrast_net = _fit(pa_, ua, contrast, seed)
    prior = estimate_prior(contrast_net.margin(pb), contrast_net.margin(ub))

    def risk(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Logistic loss: l(g) = log(1 + e^-g) for label 1, l(-g) for label 0.
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        dp, du = prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
        if negative < 0:
            return dp, -du
        return prior * (_sigmoid(gp) - 1) / len(gp) - dp, du

    net = _fit(pos, unl, risk, seed)
    net.prior = prior
    return net


def _sample(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """Features of the documents with the (bounded) ids, one row of each id, in a fixed order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_parts(b.column(1), PART_BYTES):
                x = features(data, offs)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])

    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")
    # An id may repeat in very many rows: the least features of each stand for it.
    got = rows.groupBy("doc_id").agg(F.min("x").alias("x")).orderBy(F.xxhash64("doc_id"), "x").collect()
    return np.array([r["x"] for r in got]).reshape(len(got), N_FEATURES)


def fit(docs: DataFrame, labels: DataFrame) -> Net | None:
    """Train on at most POSITIVES and UNLABELLED rows, chosen by a hash of the id, none from the held-out fold.

    A document is a positive if all its labels are 1, unlabelled if it has no
    label row at all. Null ids and labels are left out.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    learn = fold(F.col("doc_id"), FOLDS) != HELD
    marks = labels.select(F.col("doc_id").cast("long"), "quality").filter(learn)
    draw = lambda ids, n: ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id")  # noqa: E731  a top-n per task, then of these
    good = marks.groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("q")).filter("q = 1")
    none = docs.select("doc_id").filter(learn).distinct().join(marks.select("doc_id"), "doc_id", "left_anti")
    return train(_sample(docs, draw(good, POSITIVES)), _sample(docs, draw(none, UNLABELLED)))


def score(docs: DataFrame, net: Net | None) -> DataFrame:
    """doc_id, held_out, score, predicted.

    Every text is scored, null and empty ones with all features zero; without
    a net every score is 0.5. Repeated rows get equal scores; an empty table no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few kB
    schema = "doc_id long, held_out boolean, score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = shared.value
        for b in batches:
            for i, j, data, offs in text_parts(b.column(2), PART_BYTES):
                s = np.full(j - i, 0.5) if n is None else n.score(features(data, offs))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(s),
                                                  pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(run, schema)


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
