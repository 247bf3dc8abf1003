"""Word, line and character statistics of whole texts in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once (an outer reference in a lambda would be recomputed per element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def repeated_words(ws: Column, k: int = WINDOW) -> Column:
    """Words lying in a window of ``k`` words that occurs twice or more.

    Windows are compared by 64-bit hash. Texts without any equal pair (the
    usual case) stop at the distinct count; else the windows are sorted with
    their places, and the places of equal neighbours give the covered words.
    """
    def counted(hs: Column) -> Column:
        placed = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            same = lambda x, j: F.coalesce(F.get(p, j)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(p, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))

        start = F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n"))
        covered = F.aggregate(let(placed, places), start,
                              lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(k), p - a["last"])).alias("n")),
                              lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered)

    def of(hs: Column) -> Column:
        window = lambda h, i: F.xxhash64(h, *[F.get(hs, i + t) for t in range(1, k)])
        return let(F.slice(F.transform(hs, window), 1, F.size(hs) - (k - 1)), counted)

    return F.when(F.size(ws) < k, F.lit(0).cast("long")).otherwise(let(F.transform(ws, lambda w: F.xxhash64(w)), of))


def with_statistics(df: DataFrame, text: str, out: str = "s") -> DataFrame:
    """``df`` with a struct ``out`` of: n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_letters.

    A null text counts as empty: all zero.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    n_chars = lambda pattern: F.char_length(t) - F.char_length(F.regexp_replace(t, pattern, ""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^ \\t-\\r]"))

    def repeats(ls: Column) -> Column:
        return (F.size(ls) - F.size(F.array_distinct(ls))).cast("long")

    def word_struct(ws: Column) -> Column:
        return F.struct(F.size(ws).cast("long").alias("n_words"),
                        F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                        repeated_words(ws).alias("n_repeat_words"))

    df = df.withColumn(out, F.struct(
        let(words(t), word_struct).alias("w"), let(lines, repeats).alias("n_dup_lines"),
        n_chars(SYMBOLS).cast("long").alias("n_symbols"),
        n_chars("\\p{L}+").cast("long").alias("n_letters")))
    s = F.col(out)
    return df.withColumn(out, F.struct(
        s["w"]["n_words"].alias("n_words"), s["w"]["word_chars"].alias("word_chars"), s["n_symbols"],
        s["n_dup_lines"], s["w"]["n_repeat_words"].alias("n_repeat_words"),
        s["n_letters"]))
