import base64
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from barwise.llm import bpe

from .helpers import docs, odd_texts, prose


@pytest.fixture(scope="module")
def reference():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    alphabets = ["0123456789abcdef", "aab ", "thering ", "-=_#*. \n\t", "éàüñß漢字😀и ", "  ՘\U0001F600x1"]
    made = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    return made + [t or "" for t in odd_texts()] + [prose(rng, 200), "it's we'll <|endoftext|> they'd"]


def test_ids_equal_tiktoken(reference):
    coder = bpe.Codec()
    for t in texts():
        ids = np.frombuffer(coder.encode(t), "<u4").tolist()
        assert ids == reference.encode_ordinary(t), t
        assert coder.decode(np.array(ids)) == t.encode()


def test_fast_split_covers_only_agreed_characters():
    import regex
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    fast = regex.compile(public_tokenizers.PATTERN)
    for c in map(chr, [*range(0x530), *range(0x2000, 0x2070)]):
        for t in (f"a{c}b", f"1{c}2", f" {c} ", f"{c}{c}."):
            if not bpe._OTHER.search(t):
                assert fast.findall(t) == [t[a:b] for _, (a, b) in split(t)], ascii(c)


def test_offsets_and_split_characters(reference):
    coder = bpe.Codec()
    for t in ("hello  world", "漢字😀 snow☃man", "naïve café"):
        spans = coder.offsets(t)
        assert [i for i, _, _ in spans] == reference.encode_ordinary(t)
        covered = set()
        for _, a, b in spans:
            covered.update(range(a, b))
        assert covered == set(range(len(t)))
        dec = bpe.CharacterDecoder(coder)
        assert "".join(dec.feed(i) for i, _, _ in spans) + dec.end() == t


def test_small_cache_gives_the_same_ids(monkeypatch, reference):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 5)
    coder = bpe.Codec()
    for t in texts()[:200]:
        assert np.frombuffer(coder.encode(t), "<u4").tolist() == reference.encode_ordinary(t)


def test_query_rows(spark, reference):
    rows = [(i, t) for i, t in enumerate(odd_texts() + ["ab cd"] * 2)] + [(3, "again"), (None, "no id")]
    got = sorted(map(str, bpe.digests(docs(spark, rows).withColumn("ids", F.lit(1))).collect()))
    from pyspark.sql import Row
    want = []
    for i, t in rows:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()
        want.append(str(Row(doc_id=i, n_tokens=len(ids) // 4, ids_sha256=hashlib.sha256(ids).hexdigest(),
                            decoded_sha256=hashlib.sha256((t or "").encode()).hexdigest())))
    assert got == sorted(want)
    assert bpe.digests(docs(spark, [])).collect() == []
    kept = bpe.encode(docs(spark, [(1, "ab"), (2, None)]).withColumn("ids", F.lit(1))).orderBy("doc_id").collect()
    assert [len(r.ids) for r in kept] == [4 * len(reference.encode_ordinary("ab")), 0]
