"""The whole pipeline on a small corpus against plain Python, and its edges."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

from .helpers import DOC, docs, odd_texts, prose
from .test_bpe import reference  # noqa: F401
from .test_decontamination import brute as leaks
from .test_neardup import brute as copies
from .test_quality_rules import base as quality
from .test_secrets import base as secret_spans


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(6)
    bench = [(i, prose(rng, 25)) for i in range(4)]
    rows = [(i, t) for i, t in enumerate(odd_texts())]
    for i in range(100, 130):  # fewer than a pool: the fixed limits alone decide
        t = prose(rng, rng.randint(8, 60)).split()
        if i % 5 == 0:
            t += ["password=abcdef0123456789abcdef01"]
        if i % 7 == 0:
            t[3:3] = rng.choice(bench)[1].split()[:14]
        rows.append((i, " ".join(t)))
    rows += [(200 + i, rows[15 + i][1]) for i in range(4)] + [(300, rows[20][1] + " tail")] + [rows[25]]
    sf = str(tmp_path_factory.mktemp("sf"))
    docs(spark, rows).withColumn("extra", F.lit(1)).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, rows, bench


def test_run_equals_plain_python(spark, corpus, reference):  # noqa: F811
    sf, rows, bench = corpus
    left = [(i, t) for i, t in rows if not quality(t)[1]]
    left = list(dict(left).items())  # the repeated row once
    left = [(i, t) for i, t in left if {r[0]: r[3] for r in copies(left, 5)}[i]]
    left = [(i, t) for i, t in left if not {r[0]: r[5] for r in leaks(left, bench)}[i]]
    want = []
    for i, t in left:
        parts, at = [], 0
        for a, _, b in secret_spans(t):
            if a >= at:
                parts += [t[at:a], "[SECRET]"]
            at = max(at, b)
        t = "".join(parts) + t[at:]
        ids = reference.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    out = corpus_pipeline.run(spark, sf)
    got = [(r.doc_id, r.n_tokens, r.decoded_sha256) for r in out.collect()]
    assert sorted(got) == sorted(want) and len(want) > 10


def test_stages_keep_columns_and_take_empty_tables(spark, corpus):
    sf, _, _ = corpus
    none = spark.createDataFrame([], DOC)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, none, sf)
        assert out.columns == none.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, none, sf).collect() == []


def test_registered():
    names = [k for k in entry.queries() if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
