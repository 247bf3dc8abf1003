"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are its byte 2-, 3- and 4-grams within words (with a border
at either end), hashed to ``BUCKETS``. Its vector is the mean of their
embeddings; a linear layer and softmax give the language. Embeddings and layer
are trained together by mini-batch stochastic gradient descent in numpy, on a
bounded sample of labelled rows. A temperature fitted on a part of the sample
set aside calibrates the score, and the same part gives the score below which
a prediction is rejected.

For prediction the embeddings and the layer collapse into one table of bucket
by language, so a text costs a histogram of its buckets and one small product.
Texts are handled in blocks of bytes: memory does not follow their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.llm.words import text_parts

BUCKETS = 1 << 14
DIM = 16
# The bounded training sample: rows per language (documented parameter).
PER_LANGUAGE = 400
EPOCHS, BATCH, RATE = 12, 32, 4.0
# Rejection: accepted calibration rows are right at least this often.
ACCEPT = 0.99
FOLDS, HELD = 4, 2
BLOCK = 1 << 18
GROUP = 32

# Lower-case letters and bytes beyond ASCII stay, everything else is a border.
_NORMAL = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def _grams(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, bucket) of the subwords of one run of bytes."""
    x = _NORMAL[data]
    inner = x != 32
    for n in (2, 3, 4):
        if len(x) < n:
            return
        m = len(x) - n + 1
        code = np.zeros(m, np.uint32)
        ok = np.ones(m, bool)
        for t in range(n):
            code = code * np.uint32(0x01000193) + x[t:t + m] * np.uint32(0x9E3779B1)
            if 0 < t < n - 1:
                ok &= inner[t:t + m]
        if n == 2:
            ok &= inner[:m] | inner[1:]
        at = np.flatnonzero(ok)
        code = code[at]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        yield at, ((code >> np.uint32(17)) & np.uint32(BUCKETS - 1)).astype(np.int64)


def histograms(data: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, bucket counts of up to ``GROUP`` texts as rows). Subwords do not cross texts."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = min(n, i + GROUP)
        j = max(i + 1, min(j, int(np.searchsorted(offs, offs[i] + BLOCK, side="right")) - 1))
        counts = np.zeros((j - i) * BUCKETS, np.int64)
        for a in range(int(offs[i]), int(offs[j]), BLOCK):
            b = min(a + BLOCK + 3, int(offs[j]))  # a long text goes on in the next block
            for k, (at, bucket) in enumerate(_grams(data[a:b])):
                keep = at < BLOCK
                at, bucket = at[keep], bucket[keep]
                own = np.searchsorted(offs, at + a, side="right") - 1
                inside = at + a + k + 2 <= offs[own + 1]
                counts += np.bincount((own[inside] - i) * BUCKETS + bucket[inside], minlength=len(counts))
        yield i, counts.reshape(j - i, BUCKETS)
        i = j


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket by language: embeddings times layer
    bias: np.ndarray
    temperature: float
    reject: float  # scores below are not accepted

    def logits(self, counts: np.ndarray) -> np.ndarray:
        total = np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return (counts.astype(np.float32) @ self.table) / total + self.bias

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = _softmax(self.logits(counts) * self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 5) -> Model:
    """rows: (language, buckets, counts) of the sample; every fifth row calibrates."""
    languages = sorted({r[0] for r in rows})
    label = np.array([languages.index(r[0]) for r in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, used = order[::5], (np.delete(order, np.s_[::5]) if len(rows) >= 5 else order)
    emb = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
    layer = np.zeros((DIM, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)

    def means(pick: np.ndarray) -> np.ndarray:
        x = np.zeros((len(pick), BUCKETS), np.float32)
        for k, r in enumerate(pick):
            x[k, rows[r][1]] = rows[r][2]
        return x / np.maximum(x.sum(axis=1, keepdims=True), 1)

    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        used = rng.permutation(used)
        for at in range(0, len(used), BATCH):
            pick = used[at:at + BATCH]
            x = means(pick)
            h = x @ emb
            g = _softmax(h @ layer + bias)
            g[np.arange(len(pick)), label[pick]] -= 1
            g /= len(pick)
            back = x.T @ (g @ layer.T)
            layer -= rate * (h.T @ g)
            bias -= rate * np.float32(0.1) * g.sum(axis=0)
            emb -= rate * back
    model = Model(languages, emb @ layer, bias, 1.0, 0.0)
    z = np.concatenate([means(aside[a:a + BATCH]) @ model.table + bias for a in range(0, len(aside), BATCH)]) if len(aside) else np.zeros((0, len(languages)))
    if len(z):
        loss = lambda t: -np.log(np.maximum(_softmax(z * t)[np.arange(len(z)), label[aside]], 1e-12)).mean()
        model.temperature = float(min(np.geomspace(0.1, 20, 60), key=loss))
        p = _softmax(z * model.temperature)
        score, right = p.max(axis=1), p.argmax(axis=1) == label[aside]
        down = np.argsort(-score)
        precise = np.cumsum(right[down]) / np.arange(1, len(down) + 1) >= ACCEPT
        model.reject = float(score[down][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return model


def sample(docs: DataFrame, lang: str = "lang", per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Histograms of at most ``per_language`` learnable rows of each language, chosen by a hash of the id."""
    pool = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD))
    pool = pool.select("doc_id", F.col(lang).alias("lang"), "text")
    share = {r["lang"]: min(1.0, 1.5 * per_language / r["n"]) for r in pool.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not share:
        return []
    limit = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
    schema = "doc_id long, lang string, buckets binary, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_parts(b.column(2), 1 << 20):
                got = [(np.flatnonzero(r), r) for _, c in histograms(data, offs) for r in c]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                     pa.array([k.astype(np.uint16).tobytes() for k, _ in got], pa.binary()),
                     pa.array([r[k].astype(np.float32).tobytes() for k, r in got], pa.binary())],
                    names=["doc_id", "lang", "buckets", "counts"])

    chosen = pool.filter(draw < limit).select(F.col("doc_id").cast("long"), "lang", "text").mapInArrow(run, schema)
    # An id may repeat in very many rows: the least histogram of each id and language stands for it.
    chosen = chosen.groupBy("doc_id", "lang").agg(F.min(F.struct("buckets", "counts")).alias("h")).select("doc_id", "lang", "h.*")
    seen: dict[str, int] = {}
    out = []
    for r in chosen.orderBy(F.xxhash64(F.col("doc_id"), F.lit("langid")), "doc_id", "lang").toLocalIterator():
        if seen.get(r["lang"], 0) < per_language:
            seen[r["lang"]] = seen.get(r["lang"], 0) + 1
            out.append((r["lang"], np.frombuffer(r["buckets"], np.uint16).astype(np.int64), np.frombuffer(r["counts"], np.float32)))
    return out


def _has_letter(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    x = data | 32
    plain = np.concatenate(([0], np.cumsum((x >= 97) & (x <= 122))))
    out = plain[offs[1:]] > plain[offs[:-1]]
    for k in np.flatnonzero(~out).tolist():
        out[k] = any(c.isalpha() for c in bytes(data[offs[k]:offs[k + 1]]).decode("utf-8", "replace"))
    return out


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing could be learned. ``accepted``: the score reaches the calibrated
    limit. Repeated rows get equal results; empty tables give no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats
    schema = "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for i, j, data, offs in text_parts(b.column(2), 1 << 20):
                names, scores = ["und"] * (j - i), np.zeros(j - i)
                if m is not None:
                    letters = _has_letter(data, offs)
                    for at, counts in histograms(data, offs):
                        best, p = m.predict(counts)
                        for k in range(len(counts)):
                            if letters[at + k]:
                                names[at + k], scores[at + k] = m.languages[best[k]], p[k]
                ok = (scores >= (m.reject if m else 1)) & np.array([x != "und" for x in names], bool)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(names, pa.string()), pa.array(scores), pa.array(ok)],
                    names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(run, schema)


def fit_and_identify(docs: DataFrame) -> DataFrame:
    """Train on the learnable rows of ``docs`` and predict all of them."""
    rows = sample(docs)
    return identify(docs, train(rows) if rows else None)
