"""Secret scans: three fixed patterns, and a randomness test battery for other tokens.

Fixed kinds are found by pattern (``assign``, ``access``, ``hex``). Further,
every run of 20 or more letters, digits and ``+ / _ -`` that has a letter is a
candidate, letters alone included. Its encoding is inferred from the characters it uses,
its characters become numbers in that alphabet, and three statistics measure
how far it is from uniform random: chi-squared of the alphabet counts, the
runs test about the middle, and lag-one serial correlation. Their sum of
squares is small for random strings, and a token that a test for randomness
would reject is never reported.

In 20 to 30 characters many ordinary tokens pass that test too. So a token
must also be unlike ordinary ones, which a p-value measures: the chance that
an ordinary token of its own length and case has a statistic as high. The
statistic is the mean cost under a fixed model of letter pairs, less a part of
the battery for hexadecimal tokens, whose words tell little. The null is a
fixed seeded sample (``ordinary``), so nothing depends on the corpus; beyond
the tabulated shares its tail is taken as exponential. Over the candidates of
a document the step-up rule of Benjamini and Hochberg then bounds the expected
share of ordinary tokens among the reported ones by ``FDR``; so the more
candidates a document has, the stronger each must be.
There is one pass, no shuffle and no join.

Everything is DataFrame functions; positions are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.llm import ordinary
from barwise.llm.textstats import let

KINDS = ("assign", "access", "hex", "random")
# The patterns and least lengths of the three kinds.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_VALUE = 6
# A maximal run that is long enough: the same matches as dropping shorter runs.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# Words every match of ASSIGN has one of, in lower case.
ASSIGN_HINTS = ("passw", "secret", "token", "api")

TOKEN = "[A-Za-z0-9+/_-]{20,}"
# A reported token is also one that a test for randomness would pass: chi-squared
# with three degrees of freedom exceeds this with probability 0.001.
CONSISTENT = 16.27
FDR = 0.005
# Alphabets by inferred encoding, the first that holds all characters.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ALPHABETS = (("[0-9a-f]+", DIGITS + LOWER[:6]), ("[0-9A-F]+", DIGITS + UPPER[:6]),
             ("[a-z]+", LOWER), ("[A-Z]+", UPPER), ("[A-Za-z]+", UPPER + LOWER), ("[A-Z2-7]+", UPPER + DIGITS[2:8]),
             ("[0-9a-z]+", DIGITS + LOWER), ("[0-9A-Z]+", DIGITS + UPPER), ("[0-9A-Za-z]+", DIGITS + UPPER + LOWER),
             ("[0-9A-Za-z+/]+", UPPER + LOWER + DIGITS + "+/"), (".*", UPPER + LOWER + DIGITS + "-_+/"))

_SPAN = "array<struct<start:bigint,kind:int,end:bigint,token:string>>"
_GROUP = 256


def _located(gaps: Column, hits: Column, kind: int) -> Column:
    """Spans of the matches ``hits`` that lie between the text pieces ``gaps``.

    A running position over the matches, in groups, so that a text with very
    many matches does not copy its whole list at each.
    """
    steps = F.transform(hits, lambda h, i: F.struct(F.char_length(F.get(gaps, i)).cast("long").alias("gap"),
                                                    F.char_length(h).cast("long").alias("len"), h.alias("token")))

    def add(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + s["len"]
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), s["token"].alias("token"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    def group(st: Column) -> Column:
        groups = F.sequence(F.lit(0), F.floor((F.size(st) - 1) / _GROUP).cast("int"))
        empty = F.expr(f"cast(array() as {_SPAN})")

        def add_group(acc: Column, g: Column) -> Column:
            part = F.aggregate(F.slice(st, g * _GROUP + 1, _GROUP), F.struct(acc["at"].alias("at"), empty.alias("out")), add)
            return let(part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

        start = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as array<{_SPAN}>)").alias("out"))
        return F.aggregate(groups, start, add_group, lambda a: F.flatten(a["out"]))

    return let(steps, group)


def _matches(text: Column, pattern: str, kind: int, when: Column | None = None) -> Column:
    """All leftmost non-overlapping matches as spans; ``when``: a test that every text with a match passes."""
    none = F.expr(f"cast(array() as {_SPAN})")
    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda hits: F.when(F.size(hits) == 0, none).otherwise(
                    let(F.split(text, pattern, -1), lambda gaps: _located(gaps, hits, kind))))
    return found if when is None else F.when(when, found).otherwise(none)


def base_spans(text: Column) -> Column:
    """Spans of the three fixed kinds, by start, then kind."""
    low = F.lower(text)
    hint = F.lit(False)
    for w in ASSIGN_HINTS:
        hint = hint | low.contains(w)
    assign = F.filter(_matches(text, ASSIGN, 0, hint), lambda s: F.char_length(F.regexp_extract(s["token"], ASSIGN, 2)) >= ASSIGN_VALUE)
    return F.array_sort(F.concat(assign, _matches(text, ACCESS, 1, text.contains("AKIA")), _matches(text, HEX, 2)))


def battery(token: Column, alphabet: Column) -> Column:
    """Sum of squares of the three standardised statistics of a token (length 2 or more)."""
    n, k = F.char_length(token).cast("double"), F.char_length(alphabet).cast("double")
    numbers = F.transform(F.split(token, ""), lambda c: F.instr(alphabet, c).cast("double") - 1)

    def of(x: Column) -> Column:
        squares = F.aggregate(F.array_distinct(x), F.lit(0.0), lambda s, v: s + F.pow(F.size(F.filter(x, lambda y: y == v)).cast("double"), F.lit(2.0)))
        cells = k / n * squares - n
        nu = k - 1
        # Wilson-Hilferty: the cube root of a chi-squared variable is near normal.
        z1 = (F.cbrt(F.greatest(cells, F.lit(0.0)) / nu) - (1 - 2 / (9 * nu))) / F.sqrt(2 / (9 * nu))
        high = F.size(F.filter(x, lambda v: v >= k / 2)).cast("double")
        both = 2 * high * (n - high)
        changes = F.size(F.filter(x, lambda v, i: (i > 0) & ((v >= k / 2) != (F.get(x, i - 1) >= k / 2)))).cast("double")
        spread = both * (both - n) / (n * n * (n - 1))
        z2 = F.when(spread > 0, (changes - both / n) / F.sqrt(spread)).otherwise(F.sqrt(n))
        total = F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
        sq = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
        lag = F.aggregate(F.transform(x, lambda v, i: v * F.coalesce(F.get(x, i + 1), F.get(x, F.lit(0)))), F.lit(0.0), lambda s, v: s + v)
        scale = n * sq - total * total
        z3 = F.when(scale > 0, ((n * lag - total * total) / scale + 1 / (n - 1)) * F.sqrt(n - 1)).otherwise(F.sqrt(n))
        up = F.greatest(z1, F.lit(0.0))
        return up * up + z2 * z2 + z3 * z3

    return let(numbers, of)


def _alphabet(token: Column) -> Column:
    out = F.lit(ALPHABETS[-1][1])
    for pattern, alphabet in reversed(ALPHABETS[:-1]):
        out = F.when(token.rlike(f"^{pattern}$"), F.lit(alphabet)).otherwise(out)
    return out


def _class(token: Column) -> Column:
    out = F.lit(0)
    for i, least in enumerate(ordinary.LENGTHS[1:], 1):
        out = F.when(F.char_length(token) >= least, F.lit(i)).otherwise(out)
    return out


def cost(token: Column) -> Column:
    """Mean bits per neighbouring pair under the model of ordinary tokens (length 2 or more)."""
    table = F.split(F.lit(",".join(map(repr, ordinary.bits()))), ",").cast("array<double>")
    at = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ordinary.CHARS), c) - 1)
    symbols = F.transform(at, lambda i: F.when(i < 52, i).when(i < 62, F.lit(52)).otherwise(F.lit(53)))
    pairs = let(symbols, lambda x: F.transform(F.slice(x, 2, F.size(x) - 1), lambda b, i: F.get(table, F.get(x, i) * ordinary.SYMBOLS + b)))
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v) / (F.char_length(token) - 1)


_HEX = "^([0-9a-f]+|[0-9A-F]+)$"


def _tail(statistic: Column, limits: tuple[Column, Column]) -> Column:
    """The chance of a statistic as high: exponential through the two tabulated shares."""
    often, seldom = ordinary.LEVELS
    steps = (statistic - limits[1]) / (limits[1] - limits[0])
    return F.least(F.lit(1.0), seldom * F.exp(-math.log(often / seldom) * steps))


def p_value(token: Column) -> Column:
    """The chance that an ordinary token of this length and case is as unlike ordinary ones; 1 if the
    battery rejects randomness, or if it exceeds FDR anyway."""
    at = lambda tables: tuple(F.get(F.array(*[F.lit(v) for v in x]), _class(token)) for x in tables)
    hexadecimal, upper, lower = token.rlike(_HEX), token.rlike("[A-Z]"), token.rlike("[a-z]")
    pick = lambda i: F.when(upper & lower, at(ordinary.MIXED)[i]).otherwise(at(ordinary.SINGLE)[i])
    hex_pick = lambda i: F.when(upper, at(ordinary.HEX_UPPER)[i]).otherwise(at(ordinary.HEX_LOWER)[i])
    words, digits = (pick(0), pick(1)), (hex_pick(0), hex_pick(1))

    def judged(c: Column) -> Column:
        tested = F.when(hexadecimal | (_tail(c, words) <= FDR), battery(token, _alphabet(token)))
        return let(tested, lambda b: F.when(b.isNull() | (b > CONSISTENT), 1.0).when(
            hexadecimal, _tail(c - ordinary.HEX_WEIGHT * F.least(b, F.lit(ordinary.HEX_MOST)), digits)).otherwise(_tail(c, words)))

    return let(cost(token), judged)


def _discoveries(candidates: Column) -> Column:
    """The candidates that the step-up rule reports: the largest p with p <= FDR * rank / count, and all below."""
    def cut(ps: Column) -> Column:
        passed = F.transform(F.array_sort(ps), lambda p, i: F.when(p <= FDR * (i + 1) / F.size(ps), p).otherwise(-1.0))
        return F.array_max(passed)

    return let(F.transform(candidates, lambda s: p_value(s["token"])),
               lambda ps: let(cut(ps), lambda most: F.filter(candidates, lambda s, i: F.get(ps, i) <= most)))


def random_spans(text: Column, base: Column) -> Column:
    """The random ones of the text's candidates that touch no base span."""
    free = lambda s: ~F.exists(base, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
    found = F.filter(_matches(text, TOKEN, 3), lambda s: s["token"].rlike("[A-Za-z]") & free(s))
    return let(found, lambda c: F.when(F.size(c) > 0, _discoveries(c)).otherwise(c))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_base`` and ``_spans``: arrays of (start, kind, end, token), by start, then kind.

    A null text counts as empty. Texts of any length are scanned whole.
    Repeated rows and equal ids are scanned each for itself.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_base", base_spans(t))
    return docs.withColumn("_spans", F.array_sort(F.concat("_base", random_spans(t, F.col("_base")))))


def joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; see ``scan``."""
    found = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined("_base").cast("binary"), 256).alias("base_sha256"), joined("_spans").alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mask`` (overlapping ones by one
    mask), n_chars set to the new length where the column exists; all rows stay.

    Texts without a span, null ones included, are left as they are.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = scan(docs.select(whole.alias("doc"), F.col("text").alias("text")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mask))
        more = F.when(s["start"] >= a["at"], F.concat(a["out"], F.array(piece))).otherwise(a["out"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), more.alias("out"))

    end = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.char_length("text")))
    clean = F.when(F.size("_spans") == 0, F.col("text")).otherwise(F.aggregate("_spans", start, step, end))
    found = found.select("doc", clean.alias("_clean"))
    out = []
    for c in docs.columns:
        old = F.col("doc").getField(c)
        if c == "text":
            out.append(F.col("_clean").alias(c))
        elif c == "n_chars":
            out.append(F.when(F.col("_clean") == F.col("doc").getField("text"), old)
                       .otherwise(F.coalesce(F.char_length("_clean").cast(docs.schema[c].dataType), old)).alias(c))
        else:
            out.append(old.alias(c))
    return found.select(*out)
