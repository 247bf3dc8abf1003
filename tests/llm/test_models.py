"""Language identification and the quality classifier: held-out accuracy, edges."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwise.llm import langid, quality_pu

from .helpers import docs, odd_texts

SYLL = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "zt"], "cc": ["éa", "qu", "ou", "eux"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLL[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def langs(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(rng.choice(list(SYLL)) for _ in range(600))]
    rows += [(1000 + i, t, None) for i, t in enumerate(odd_texts() + ["123 456", "é", "漢"])] + [(None, "kalomi", "aa")]
    return rows


def test_language_accuracy_on_held_out_rows(spark, langs):
    got = {r.doc_id: r for r in langid.fit_and_identify(docs(spark, langs).withColumn("score", F.lit("x"))).collect()}
    truth = {r[0]: r[2] for r in langs}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(600))
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.98
    for i, t in enumerate(odd_texts() + ["123 456", "é", "漢"]):
        r = got[1000 + i]
        letter = any(c.isalpha() for c in t or "")
        assert (r.lang_pred in SYLL) == letter and (r.lang_pred == "und") != letter
        assert 0 <= r.score <= 1
    assert got[None].held_out is False


def test_language_edges(spark):
    assert langid.fit_and_identify(docs(spark, [])).collect() == []
    none = langid.fit_and_identify(docs(spark, [(1, "word", None), (2, None, None)])).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = langid.fit_and_identify(docs(spark, [(i, "word here", "aa") for i in range(8)])).collect()
    assert {r.lang_pred for r in one} == {"aa"}


def test_long_texts_are_read_in_blocks(monkeypatch):
    data = np.frombuffer(" ".join(f"word{i} ünd" for i in range(400)).encode(), np.uint8)
    offs = np.array([0, 0, 900, len(data)])
    whole = np.concatenate([c for _, c in langid.histograms(data, offs)])
    monkeypatch.setattr(langid, "BLOCK", 97)
    cut = np.concatenate([c for _, c in langid.histograms(data, offs)])
    assert (whole == cut).all()


def quality_rows():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        good = rng.random() < 0.7
        t = text(rng, "aa", rng.randint(20, 80))
        if not good:
            t = rng.choice([t.upper() + "!!", " | ".join(t.split()), " ".join([t.split()[0]] * 60)])
        rows.append((i, t))
        if rng.random() < 0.5:
            labels.append((i, int(good), 0))
    return rows, labels


def test_quality_accuracy_on_held_out_rows(spark):
    rows, labels = quality_rows()
    lab = spark.createDataFrame(labels + [(None, 1, 0), (9999, None, 0)], "doc_id long, quality int, toxic int")
    extra = [(5000 + i, t) for i, t in enumerate(odd_texts())] + [(None, "kalo mi"), rows[0]]
    got = quality_pu.fit_and_score(docs(spark, rows + extra), lab).collect()
    by = {r.doc_id: r for r in got}
    held = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([by[i].predicted == q for i, q in held]) > 0.95
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_quality_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_pu.fit_and_score(docs(spark, []), empty).collect() == []
    assert {r.score for r in quality_pu.fit_and_score(docs(spark, [(1, "a"), (2, None)]), empty).collect()} == {0.5}


def test_prior_estimate():
    rng = np.random.default_rng(0)
    pos, neg = rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000)
    for share in (0.3, 0.8):
        unl = np.concatenate([rng.normal(2, 1, int(4000 * share)), neg[: int(4000 * (1 - share))]])
        assert abs(quality_pu.estimate_prior(pos, unl) - share) < 0.05


def test_one_id_in_a_third_of_the_rows_stays_bounded(spark):
    """Rows that repeat an id count once in the samples, whatever their texts."""
    rng = random.Random(6)
    rows = [(i, text(rng, "aa", 20), "aa") for i in range(60)] + [(7, text(rng, "aa", 20), "aa") for _ in range(300)]
    assert len(langid.sample(docs(spark, rows))) == len({i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2})
    ids = spark.range(10).select(F.col("id").alias("doc_id"))
    one = quality_pu._sample(docs(spark, rows).select("doc_id", "text"), ids)
    assert one.shape == (10, quality_pu.N_FEATURES)
    assert (one == quality_pu._sample(docs(spark, rows[::-1]).select("doc_id", "text"), ids)).all()
