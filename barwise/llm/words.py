"""Words of Arrow text columns as 64-bit hashes, without building Python strings.

The texts of a record batch lie end to end in one UTF-8 buffer. A byte table
says which bytes belong to words (and lower-cases A-Z), so word borders and
polynomial hashes come from a handful of numpy passes over the bytes. Work is
done in blocks of about a megabyte cut at word borders, so memory follows the
longest single word and not the longest text.

Words are compared by hash: 64 bits, well mixed. Two different words of one
comparison collide with probability 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def _byte_table(is_word) -> np.ndarray:
    """Per byte a random odd 64-bit value, 0 for separators; A-Z share the value of a-z."""
    vals = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros(256, np.uint64)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            out[b] = vals[low]
    return out


# Words of letters, digits and anything beyond ASCII.
ALNUM = _byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
# Words between ASCII white space.
SPACED = _byte_table(lambda b: not (b == 32 or 9 <= b <= 13))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, BLOCK + 4096)
            cls.up = np.full(size, _BASE, np.uint64)
            cls.up[0] = 1
            cls.up = np.cumprod(cls.up, dtype=np.uint64)
            cls.down = np.full(size, _INV, np.uint64)
            cls.down[0] = 1
            cls.down = np.cumprod(cls.down, dtype=np.uint64)
        return cls.up, cls.down


def _cut(data: np.ndarray, table: np.ndarray, pos: int, end: int) -> int:
    """The last separator in [pos, end), or else the next one after end."""
    back = np.flatnonzero(table[data[max(pos, end - 65536):end]] == 0)
    if len(back):
        return max(pos, end - 65536) + int(back[-1]) + 1
    while end < len(data):
        ahead = np.flatnonzero(table[data[end:end + BLOCK]] == 0)
        if len(ahead):
            return end + int(ahead[0]) + 1
        end += BLOCK
    return len(data)


def word_hashes(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word).

    ``data``: bytes of all texts; ``bounds``: their n + 1 offsets into it.
    The second array has n + 1 entries; text i owns words first[i]:first[i + 1].
    """
    hashes, counts = [], np.zeros(len(bounds), np.int64)
    pos = 0
    while pos < len(data):
        end = min(len(data), pos + BLOCK)
        if end < len(data):
            end = _cut(data, table, pos, end)
        vals = table[data[pos:end]]
        mask = vals != 0
        at = bounds[(bounds > pos) & (bounds < end)] - pos
        opens = mask.copy()
        opens[1:] &= ~mask[:-1]
        opens[at] = mask[at]
        shuts = mask.copy()
        shuts[:-1] &= ~mask[1:]
        shuts[at - 1] = mask[at - 1]
        s, e = np.flatnonzero(opens), np.flatnonzero(shuts) + 1
        up, down = _Powers.upto(end - pos + 1)
        total = np.zeros(end - pos + 1, np.uint64)
        np.cumsum(vals * up[: end - pos], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * down[s]))
        # A text's first word: words that start before its offset, over all blocks.
        counts += np.searchsorted(s, np.clip(bounds - pos, 0, end - pos))
        pos = end
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def text_parts(col: pa.Array | pa.ChunkedArray, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes of text (or one longer row).

    Yields (first row, end row, bytes, offsets into the bytes). Null reads as empty.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    if not len(col):
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    offs = offs[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(col):
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), len(col))
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j
