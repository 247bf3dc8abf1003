import hashlib
import random
import re

from pyspark.sql import functions as F

from barwise.llm import ordinary
from barwise.llm import secrets as sc

from .helpers import docs, odd_texts, prose

KEY = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
ASSIGN = re.compile(rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def plain_p(t):
    """``secrets.p_value`` of a token in plain Python, without the short cut above FDR."""
    i = max(k for k, n in enumerate(ordinary.LENGTHS) if len(t) >= n)
    alphabet = next(a for p, a in sc.ALPHABETS if re.fullmatch(p, t))
    b = ordinary.battery([alphabet.index(c) for c in t], len(alphabet))
    if b > sc.CONSISTENT:
        return 1.0
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", t):
        x, table = ordinary.cost(t) - 0.03 * min(b, 40), ordinary.HEX_UPPER if re.search("[A-Z]", t) else ordinary.HEX_LOWER
    else:
        x, table = ordinary.cost(t), ordinary.MIXED if re.search("[a-z]", t) and re.search("[A-Z]", t) else ordinary.SINGLE
    u, v = table[0][i], table[1][i]
    return min(1.0, 0.001 * 20 ** (-(x - v) / (v - u)))


def plain_random(text):
    """(start, kind, end) of the random spans: plain candidates, p-values and step-up rule."""
    taken = [(a, e) for a, _, e in base(text)]
    found = [(m.start(), m.end(), m.group()) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text or "") if re.search("[A-Za-z]", m.group())]
    found = [f for f in found if not any(a < f[1] and f[0] < e for a, e in taken)]
    ps = [plain_p(t) for _, _, t in found]
    passed = [p for i, p in enumerate(sorted(ps)) if p <= sc.FDR * (i + 1) / len(ps)]
    return [(a, 3, e) for (a, e, _), p in zip(found, ps) if passed and p <= max(passed)]


def named(spans):
    return ",".join(f"{sc.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def fixture():
    rng = random.Random(2)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    tricky = ["token=token:abcdefgh", "PassWord == 'abcdef'", "api_key: abc", "apikey=\"x.y/z+w=1-2_3\"", "ſecret=abcdefgh toKen=abcdefgh",
              "AKIA" + "A" * 15, "AKIA" + "B" * 16, "AKIAAKIA" + "C" * 20, hexes(23), "é☃ " + hexes(24) + " 😀 password=" + hexes(30), hexes(5000)]
    rows = [(i, t) for i, t in enumerate(odd_texts() + tricky)]
    rows += [(100 + i, prose(rng, 30) + f" secret: {hexes(rng.randint(3, 40))} " + prose(rng, 5) + " " + "AKIA" + "Z9" * rng.randint(5, 12)) for i in range(40)]
    many = " ".join("token=" + hexes(8) for _ in range(900))
    return rows + [(500, many), (500, many), (None, many)]


def test_base_spans_equal_plain_regex(spark):
    rows = fixture()
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in sc.report(docs(spark, rows).withColumn("_base", F.lit(1))).collect())
    want = []
    for i, t in rows:
        b = base(t)
        kinds = [k for _, k, _ in b]
        want.append((str(i), kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(named(b).encode()).hexdigest()))
    assert got == sorted(want)
    assert sc.report(docs(spark, [])).collect() == []


def test_battery_tells_random_strings_from_words(spark):
    rng = random.Random(5)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    syll = ["th", "er", "ing", "on", "re", "ed", "nd"]
    long_word = lambda: "".join(rng.choice(syll) for _ in range(30))
    keys = ["".join(rng.choice(chars) for _ in range(48)) for _ in range(30)]
    keys = [k for k in keys if re.search("[0-9]", k)]
    rows = [(i, " ".join(long_word() for _ in range(12))) for i in range(300)]
    dull = ["abc123" * 8, "0a" * 24, "theword1" * 6]
    rows += [(1000 + i, f"see {k} here") for i, k in enumerate(keys)] + [(2000 + i, f"see {k} here") for i, k in enumerate(dull)]
    spans = {r.doc_id: r.spans for r in sc.report(docs(spark, rows)).collect()}
    found = sum(spans[1000 + i] == f"random:4:{4 + len(k)}" for i, k in enumerate(keys))
    assert found >= 0.9 * len(keys)
    assert not any("random" in spans[2000 + i] for i in range(3)) and not any(spans[i] for i in range(300))


def test_statistics_equal_plain_python(spark):
    tok, alpha = "9f8b3c0d7a6e1f2b4c5d9e8f7a6b5c4d", "0123456789abcdef"
    got = spark.range(1).select(sc.battery(F.lit(tok), F.lit(alpha)).alias("q")).first().q
    x = [alpha.index(c) for c in tok]
    n, k = len(x), 16
    chi = k / n * sum(x.count(v) ** 2 for v in set(x)) - n
    z1 = ((chi / 15) ** (1 / 3) - (1 - 2 / 135)) / (2 / 135) ** 0.5
    high = [v >= 8 for v in x]
    both = 2 * sum(high) * (n - sum(high))
    z2 = (sum(a != b for a, b in zip(high, high[1:])) - both / n) / (both * (both - n) / (n * n * (n - 1))) ** 0.5
    s, q = sum(x), sum(v * v for v in x)
    lag = sum(a * b for a, b in zip(x, x[1:] + x[:1]))
    z3 = ((n * lag - s * s) / (n * q - s * s) + 1 / (n - 1)) * (n - 1) ** 0.5
    assert abs(got - (max(z1, 0) ** 2 + z2 ** 2 + z3 ** 2)) < 1e-9


def test_redaction(spark):
    rows = fixture()
    d = docs(spark, rows).withColumn("_spans", F.lit("x"))
    out = sc.redact(d)
    assert out.columns == d.columns
    want = []
    for i, t in rows:
        parts, at = [], 0
        spans = sorted(base(t) + plain_random(t))
        for a, _, b in spans:
            if a >= at:
                parts += [t[at:a], "[SECRET]"]
            at = max(at, b)
        want.append((str(i), t if not spans else "".join(parts) + t[at:]))
    got = [(str(r.doc_id), r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text or "") for r in out.collect())


def keys(rng, chars, n, many):
    return ["".join(rng.choice(chars) for _ in range(n)) for _ in range(many)]


B62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
ORDINARY = ["user_profile_image_2024_large", "getElementById2AndReturnValue", "src/main/java/com/example/App2", "Geschwindigkeit100Begrenzung", "2024-12-04-report-final-version"]


def test_random_tokens_do_not_depend_on_the_corpus(spark):
    key = "q7RzK2vXw9LmB4tYc8HsJ3pD"
    alone = sc.report(docs(spark, [(1, f"see {key} here")])).first().spans
    words = [(i + 2, " ".join(ORDINARY)) for i in range(50)]
    among = {r.doc_id: r.spans for r in sc.report(docs(spark, [(1, f"see {key} here")] + words)).collect()}
    assert alone == among[1] == f"random:4:{4 + len(key)}"
    assert not any(among[i] for i, _ in words)


def test_limits_and_cost_are_those_of_the_model(spark):
    for i in (0, 4):
        n = ordinary.LENGTHS[i]
        for got, table in ((ordinary.cost_limits(n, False), ordinary.SINGLE), (ordinary.cost_limits(n, True), ordinary.MIXED),
                           (ordinary.hex_limits(n, False), ordinary.HEX_LOWER), (ordinary.hex_limits(n, True), ordinary.HEX_UPPER)):
            assert all(abs(a - t[i]) <= 0.011 for a, t in zip(got, table))
    tokens = ORDINARY + ["aB3+/_-Zz9" * 3]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", sc.cost(F.col("t")).alias("c")).collect()
    assert all(abs(r.c - ordinary.cost(r.t)) < 1e-9 for r in got)


def test_false_discovery_control_equals_plain_step_up(spark):
    rng = random.Random(12)
    made = lambda n: ordinary._joined(rng, n, ordinary.WORDS[1::2], rng.randrange(5))
    rows = []
    for d in range(60):
        toks = [made(rng.randint(20, 50)) for _ in range(rng.randint(0, 12))]
        toks += keys(rng, rng.choice([B62, B62[26:], B62[:26], "0123456789ABCDEF"]), rng.randint(20, 36), rng.randint(0, 4))
        rng.shuffle(toks)
        rows.append((d, " ".join(toks)))
    rows.append((60, rows[0][1]))
    got = {r.doc_id: r.spans for r in sc.report(docs(spark, rows)).collect()}
    some = 0
    for d, text in rows:
        want = [f"random:{a}:{e}" for a, _, e in plain_random(text)]
        assert [x for x in got[d].split(",") if x.startswith("random")] == want
        some += len(want)
    assert some > 40


def test_share_of_ordinary_tokens_reported(spark):
    """Documents of ordinary tokens alone: at most about FDR of them have a report, few or many tokens each."""
    rng = random.Random(99)
    tokens = [ordinary._joined(rng, rng.choice((20, 26, 32, 44)), ordinary.WORDS[1::2], rng.randrange(5)) for _ in range(6000)]
    rows = [(i, " ".join(tokens[i:i + 1])) for i in range(3000)] + [(3000 + i, " ".join(tokens[3000 + 10 * i:3010 + 10 * i])) for i in range(300)]
    got = sc.report(docs(spark, rows)).filter("spans <> ''").collect()
    assert sum(r.doc_id < 3000 for r in got) <= 30 and sum(r.doc_id >= 3000 for r in got) <= 5


def test_planted_keys_of_every_length_are_found(spark):
    rng = random.Random(8)
    letters = [k for k in keys(rng, B62, 20, 4000) if k.isalpha()]
    sets = {(n, c): keys(rng, chars, n, 100) for n in (20, 24, 32, 40, 48, 64) for c, chars in (("base62", B62), ("base36", B62[26:]))}
    sets[20, "letters"] = letters[:80]
    sets |= {(n, c): keys(rng, chars, n, 100) for n in (28, 32, 40, 48, 64) for c, chars in (("HEX", "0123456789ABCDEF"), ("upper", B62[:26]), ("lower", B62[26:52]))}
    kinds = ("base62", "base36", "letters", "HEX", "upper", "lower")
    rows = [(10 * n + kinds.index(c), f"see {k} here") for (n, c), many in sets.items() for k in many]
    got = sc.report(docs(spark, rows)).collect()
    found = {}
    for r in got:
        found[r.doc_id] = found.get(r.doc_id, 0) + ("random" in r.spans)
    for (n, c), many in sets.items():
        assert found[10 * n + kinds.index(c)] >= (0.85 if n < 32 else 0.95) * len(many), (n, c)
    plain = ["thisisaverylongidentifier", "internationalization/configuration", "Donaudampfschifffahrtsgesellschaft", "--------------------------"]
    assert not any(r.spans for r in sc.report(docs(spark, list(enumerate(plain)))).collect())
