import random

from pyspark.sql import functions as F

from barwise.llm import licenses as lc

from .helpers import ALNUM, docs, low, odd_texts, prose


def grams(t):
    w = ALNUM.findall(low(t))
    return set(zip(w, w[1:]))


def brute(text):
    text = text or ""
    parts, run = [text], []
    for line in text.split("\n") + [""]:
        parts.append(line)
        if ALNUM.search(low(line)):
            run.append(line)
        else:
            parts.append("\n".join(run))
            run = []
    best = {}
    for p in parts:
        for name, t in lc.TEMPLATES:
            a, b = grams(p), grams(t)
            d = 2 * len(a & b) / (len(a) + len(b)) if a else 0
            if d >= lc.THRESHOLD:
                best[name] = max(d, best.get(name, 0))
    first = min(((-d, n) for n, d in best.items()), default=(None, None))
    return len(best), ",".join(sorted(best)), first[1], first[0] and -first[0]


def test_matches_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    for i in range(60):
        t = rng.choice(lc.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(["other", "the", "LICENSE"])
        cut = rng.choice([" ", "\n"]) if len(t) > 20 else " "
        notice = cut.join(t).upper() if rng.random() < 0.2 else cut.join(t)
        rows.append((100 + i, rng.choice(["", prose(rng, 9) + "\n", prose(rng, 9) + "\n--\n"]) + notice + rng.choice(["", "\n\n" + prose(rng, 30)])))
    rows += [rows[-1], (None, "All rights reserved.")]
    got = lc.scan(docs(spark, rows).withColumn("licenses", F.lit(0))).collect()
    want = sorted((str(i), *brute(t)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_licenses, r.licenses, r.best_license, r.best_dice) for r in got) == want
    assert sum(r.n_licenses > 0 for r in got) > 30
    assert lc.scan(docs(spark, [])).collect() == []


def test_notices_across_paragraphs_and_inside_lines(spark):
    full = dict(lc.TEMPLATES)
    apache = full["apache-2.0-notice"].replace(" http://", "\n\n   http://").replace("LICENSE-2.0 Unless", "LICENSE-2.0\n\nUnless")
    gpl = full["gpl-3.0-notice"].replace("version. This", "version.\n\nThis")
    code = "import os\n\n" + prose(random.Random(4), 200)
    rows = [(1, f"{code}\n\n{apache}\n\n{code}", "apache-2.0-notice"), (2, f"{code}\n\n{gpl}\n\n{code}", "gpl-3.0-notice"),
            (3, "Copyright 2020 Example Corp. All rights reserved.", "all-rights-reserved"),
            (4, "This small tool was written in a week and is Released under the MIT License. Have fun with it.", "mit"), (5, code, "")]
    got = {r.doc_id: r.licenses.split(",") for r in lc.scan(docs(spark, rows)).collect()}
    assert all(want in got[i] for i, _, want in rows) and got[5] == [""]
