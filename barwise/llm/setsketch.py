"""SetSketch registers of shingle sets, and the joint likelihood estimate of their similarity.

Register i of a set holds floor(1 - log_b(min over elements of h_i)), with h_i
exponential of rate ``RATE`` per element, cut to 0..65535. Registers of a union
are the elementwise maxima, so sketches merge. With b close to 1 two registers
agree with probability close to the Jaccard similarity, as in MinHash, while a
register takes two bytes at any set size.

An element's values are produced in ascending order (sums of exponential
spacings) and dealt to the registers in an order of its own, so an element is
done once its next value cannot lower any register. All sets of a batch run
in step: round j handles the j-th value of every element still open.
"""

from __future__ import annotations

import math

import numpy as np

from barwise.llm.words import SPACED, mix, word_hashes

REGISTERS = 256
BASE = 1.001
RATE = 20.0
TOP = 65535


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts end to end, n + 1 offsets).

    Words are lower-cased and split at ASCII white space. A text of fewer than
    ``k`` words is one shingle, its whole sequence; one without words has none.
    """
    words, first = word_hashes(data, offs, SPACED)
    n = np.diff(first)
    h = np.full(max(len(words) - k + 1, 0), k, np.uint64)
    for t in range(k):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + words[t:t + len(h)])
    parts, sizes = [], np.zeros(len(n) + 1, np.int64)
    for i, (a, c) in enumerate(zip(first[:-1].tolist(), n.tolist())):
        if c >= k:
            s = np.sort(h[a:a + c - k + 1])
            s = s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif c:
            s = np.full(1, c, np.uint64)
            for w in words[a:a + c]:
                s = mix(s * np.uint64(0x9FB21C651E98DF25) + w)
        else:
            continue
        parts.append(s)
        sizes[i + 1] = len(s)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(sizes)


def registers(elements: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of ``REGISTERS`` uint16 values for each set of a batch."""
    m, sets = REGISTERS, len(offs) - 1
    out = np.zeros((sets, m), np.uint16)
    if not len(elements):
        return out
    owner = np.repeat(np.arange(sets), np.diff(offs))
    order = mix(elements ^ np.uint64(0x5851F42D4C957F2D))
    first = (order & np.uint64(255)).astype(np.int64)
    stride = ((order >> np.uint64(8)) & np.uint64(127)).astype(np.int64) * 2 + 1
    swap = ((order >> np.uint64(16)) & np.uint64(255)).astype(np.int64)
    value = np.zeros(len(elements))
    flat = out.reshape(-1)
    h = elements
    for j in range(m):
        bits = mix(h + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u = ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        value = value - np.log(u) / (RATE * (m - j))
        level = np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, TOP).astype(np.uint16)
        if j:  # the lowest register is 0 before the first round
            open_ = level > out.min(axis=1)[owner]
            if not open_.all():
                h, owner, value, level = h[open_], owner[open_], value[open_], level[open_]
                first, stride, swap = first[open_], stride[open_], swap[open_]
                if not len(h):
                    break
        np.maximum.at(flat, owner * m + (((j ^ swap) * stride + first) & (m - 1)), level)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def similarity(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard estimates, row by row, for known set sizes.

    From the counts of registers where a is above, below and equal to b; the
    closed form of the joint likelihood's maximum for a base near 1.
    """
    up = (ra > rb).sum(axis=1).astype(float)
    down = (ra < rb).sum(axis=1).astype(float)
    same = ra.shape[1] - up - down
    u, v = na / (na + nb), nb / (na + nb)
    x, y = u * u * (same + down), v * v * (same + up)
    return (x + y - np.sqrt((x - y) ** 2 + 4 * down * up * u * u * v * v)) / (2 * u * v * ra.shape[1])
