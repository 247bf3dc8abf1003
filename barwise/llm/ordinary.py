"""Ordinary tokens: a fixed letter model, and seeded samples of any length as a null.

The model is trained on one half of a fixed word list in four languages; the
samples are joined from the other half in the usual spellings (plain, camel,
upper, with separators, with numbers). Nothing depends on the corpus.
"""

from __future__ import annotations

import math
import random
from functools import lru_cache

LETTERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
# Characters of a token by kind: lower, upper, digit, separator.
CHARS = LETTERS + LETTERS.upper() + DIGITS + "+/_-"
SYMBOLS = 54  # 26 lower, 26 upper, one for digits, one for separators
SAMPLES, SEED = 4000, 17
LEVELS = (0.02, 0.001)  # shares of ordinary tokens whose exceeded statistic is tabulated
HEX_WEIGHT, HEX_MOST = 0.03, 40.0  # what a unit of the battery takes off a hexadecimal token's cost, up to this

WORDS = """the and for with from this that which have their about would there other into more some time than these only over also after
first people because between through where before must such through back years much your way well down should great world still
house water number order value index result state group error event user name file path page view item table image text line test
type count total level model node update create delete server client network message letter string buffer function return module
service account password key public private static final class import export package config setting default request response
question information international development government management understanding technology application environment
description configuration authentication transaction organization university important available different possible company
und der die das ist nicht mit auf sich werden haben einer auch nach bei zeit jahr haus wasser arbeit leben welt kinder schule
gesellschaft wissenschaft entwicklung verantwortung geschwindigkeit zusammenhang versicherung bundesregierung krankenhaus
freundschaft wirtschaft moeglichkeit unterschied entscheidung verwaltung rechtschreibung schlichen keitlich heitlich beeinflussung
pour dans les des que une avec plus sont mais nous vous cette comme tout faire monde maison eau temps travail enfant ville
developpement gouvernement connaissance appartement anniversaire evidemment heureusement bonjour aujourd beaucoup toujours eaux
los las para con una por como pero sus este entre cuando todo ser tiempo mundo casa agua trabajo ciudad escuela persona gracias
informacion conocimiento desarrollo universidad naturalmente aproximadamente responsabilidad verdad siempre mientras
ing tion ment ness able ible ology ship hood less ward ough ight ation ement ence ance ity ous ive ful ung lich keit heit schaft
amente cion idad ador ables eur aux oux ement ique aire""".split()
# Words that letters a to f alone make.
HEX_WORDS = "face bead cafe deed fade decade feed added bad dead beef ace bed fed add cab dad fab ebb bee".split()


def _symbol(c: str) -> int:
    i = CHARS.index(c)
    return i if i < 52 else 52 if i < 62 else 53


def _joined(rng: random.Random, n: int, words: list[str], style: int) -> str:
    """A token of n characters: words and numbers in one spelling."""
    out = ""
    while len(out) < n + 8:
        if style and rng.random() < 0.25:
            part = rng.choice([str(rng.randint(1900, 2030)), str(rng.randint(0, 9)), f"{rng.randint(0, 99):02}", "000", "123"])
        else:
            part = rng.choice(words)
            part = part.capitalize() if style == 2 else part.upper() if style == 3 else part
        out += part + (rng.choice("_-/") if style == 4 else "")
    at = rng.randrange(8)
    return out[at:at + n]


@lru_cache(maxsize=1)
def bits() -> tuple[float, ...]:
    """SYMBOLS x SYMBOLS costs: minus log2 of the chance of a symbol after another one in ordinary tokens."""
    kind = lambda s: s // 26 if s < 52 else s - 50
    rng = random.Random(SEED)
    kinds = [[1.0] * 4 for _ in range(4)]
    letters = [[0.3] * 26 for _ in range(27)]
    for i in range(6000):
        t = [_symbol(c) for c in _joined(rng, 40, WORDS[::2], i % 5)]
        for a, b in zip(t, t[1:]):
            kinds[kind(a)][kind(b)] += 1
            if b < 52:
                letters[a % 26 if a < 52 else 26][b % 26] += 1 / 60  # a sample is no 40 new pairs
    out = []
    for a in range(SYMBOLS):
        for b in range(SYMBOLS):
            k, row = kinds[kind(a)], letters[a % 26 if a < 52 else 26]
            p = k[kind(b)] / sum(k) * (row[b % 26] / sum(row) if b < 52 else 0.1 if b == 52 else 0.25)
            out.append(-math.log2(p))
    return tuple(out)


def cost(token: str) -> float:
    """Mean bits per neighbouring pair of a token under the model."""
    t, table = [_symbol(c) for c in token], bits()
    return sum(table[a * SYMBOLS + b] for a, b in zip(t, t[1:])) / (len(t) - 1)


def _exceeded(values: list[float]) -> tuple[float, ...]:
    """The value that each share of LEVELS of ``values`` exceeds."""
    got = sorted(values)
    return tuple(got[-1 - int(level * len(got))] for level in LEVELS)


def cost_limits(n: int, mixed: bool) -> tuple[float, ...]:
    """The costs that shares LEVELS of ordinary tokens of n characters exceed; the largest over the
    spellings with capitals and small letters (``mixed``) or with one of them."""
    top = []
    for style in (2,) if mixed else (0, 1, 3, 4):
        rng = random.Random(SEED + n)
        top.append(_exceeded([cost(_joined(rng, n, WORDS[1::2], style)) for _ in range(SAMPLES)]))
    return tuple(map(max, zip(*top)))


def battery(x: list[int], k: int) -> float:
    """``secrets.battery`` of numbers below k."""
    n = len(x)
    cells, nu = k / n * sum(x.count(v) ** 2 for v in set(x)) - n, k - 1
    z1 = ((max(cells, 0) / nu) ** (1 / 3) - (1 - 2 / (9 * nu))) / (2 / (9 * nu)) ** 0.5
    high = [v >= k / 2 for v in x]
    both = 2 * sum(high) * (n - sum(high))
    spread = both * (both - n) / (n * n * (n - 1))
    z2 = (sum(a != b for a, b in zip(high, high[1:])) - both / n) / spread ** 0.5 if spread > 0 else n ** 0.5
    s, q, lag = sum(x), sum(v * v for v in x), sum(a * b for a, b in zip(x, x[1:] + x[:1]))
    scale = n * q - s * s
    z3 = ((n * lag - s * s) / scale + 1 / (n - 1)) * (n - 1) ** 0.5 if scale > 0 else n ** 0.5
    return max(z1, 0) ** 2 + z2 ** 2 + z3 ** 2


def hex_statistic(token: str) -> float:
    """Cost less the battery's part, of a hexadecimal token."""
    return cost(token) - HEX_WEIGHT * min(battery([(DIGITS + LETTERS[:6]).index(c) for c in token.lower()], 16), HEX_MOST)


def hex_limits(n: int, upper: bool) -> tuple[float, ...]:
    """``cost_limits`` of the statistic of hexadecimal tokens."""
    rng = random.Random(SEED + n)
    words = [w.upper() for w in HEX_WORDS] if upper else HEX_WORDS
    return _exceeded([hex_statistic(_joined(rng, n, words, 1)) for _ in range(SAMPLES)])


# Least length of each class and the limits of that length at each of LEVELS (tested).
LENGTHS = (20, 22, 24, 28, 32, 40, 48, 64)
SINGLE = ((5.35, 5.35, 5.31, 5.18, 5.12, 5.06, 4.98, 4.92), (5.95, 5.9, 5.8, 5.66, 5.56, 5.36, 5.3, 5.25))
MIXED = ((6.45, 6.41, 6.34, 6.25, 6.17, 6.04, 5.98, 5.86), (7.12, 7.03, 6.98, 6.7, 6.56, 6.44, 6.36, 6.22))
HEX_LOWER = ((5.34, 5.3, 5.21, 5.04, 4.98, 4.74, 4.5, 4.2), (5.71, 5.61, 5.7, 5.45, 5.35, 5.11, 4.94, 4.6))
HEX_UPPER = ((5.26, 5.2, 5.13, 4.97, 4.9, 4.67, 4.42, 4.16), (5.58, 5.51, 5.52, 5.32, 5.2, 5.02, 4.81, 4.53))
