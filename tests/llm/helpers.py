"""Small fixtures and plain-Python versions shared by the tests."""

from __future__ import annotations

import random
import re

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def low(text):
    return (text or "").translate(LOW)


def prose(rng, n, vocab=None):
    """n words; from ``vocab`` or made up of syllables."""
    syll = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    made = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    return " ".join(rng.choice(vocab) if vocab else made() for _ in range(n))


def docs(spark, rows, parts=3):
    """rows: (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOC).repartition(parts)


def odd_texts():
    """Texts at the edges: null, empty, blank, one word, beyond ASCII, control characters, very long."""
    rng = random.Random(9)
    return [None, "", "   \n\t ", "word", "Ünïcödé ☃ 漢字 слово", "\x1c\x85 a b", "A" * 5000, prose(rng, 30000), "x\n" * 50, "a b a b a b a b a b a b"]


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
