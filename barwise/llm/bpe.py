"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

Texts are cut into pieces by the vocabulary's split pattern. Each piece's UTF-8
bytes are written as the printable characters of the byte table (one character
a byte), which is the alphabet of the library's BPE model; the model then
returns ids and offsets in these characters, that is in bytes of the piece.
Pieces repeat a lot, so a worker keeps the ids of the pieces it has met (up to
a bound, then it starts over) and asks the model only for new ones.

Decoding reverses the byte table per id. A token may hold part of a character;
``CharacterDecoder`` gives the text that each further token completes.

The vocabulary's folder is found by the installed ``public_tokenizers`` package
on every machine; file names are parameters, nothing is copied.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANKS, MODEL = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
CACHE_PIECES = 100_000
PART_BYTES = 2 << 20  # of text that one output batch is made from, a longer text alone
# Characters for which the regex module and the tokenizers library agree on
# letters, numbers and spaces (checked over all of them in the tests). Texts
# with other characters are cut by the library itself.
_OTHER = re.compile("[^\u0000-ԯ -⁯]")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it is a
    printable Latin-1 character, else the next one from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


class Codec:
    """Ids, offsets and bytes of one vocabulary."""

    def __init__(self, ranks: str = RANKS, model: str = MODEL) -> None:
        import base64

        import public_tokenizers
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        with open(public_tokenizers.path(ranks), "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.bytes_of = {int(i): base64.b64decode(t) for t, i in pairs}
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.model = Tokenizer.from_file(public_tokenizers.path(model)).model
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.other_split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        chars = byte_characters()
        self.to_char = {b: c for b, c in enumerate(chars)}
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if _OTHER.search(text):
            return [text[a:b] for _, (a, b) in self.other_split(text)]
        return self.split(text)

    def tokens(self, piece: str) -> list[tuple[int, int, int]]:
        """(id, start, end) with byte offsets in the piece."""
        mapped = piece.encode().decode("latin-1").translate(self.to_char)
        out, at = [], 0
        for t in self.model.tokenize(mapped):
            out.append((t.id, at, at + len(t.value)))  # a character of the value is a byte of the piece
            at += len(t.value)
        return out

    def ids(self, piece: str) -> bytes:
        mapped = piece.encode().decode("latin-1").translate(self.to_char)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped)])

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known = self.known
        pieces = self.pieces(text)
        try:
            return b"".join([known[p] for p in pieces])
        except KeyError:
            for p in pieces:
                if p not in known:
                    if len(known) >= CACHE_PIECES:
                        known.clear()
                        return self._encode_fresh(pieces)
                    known[p] = self.ids(p)
            return b"".join([known[p] for p in pieces])

    def _encode_fresh(self, pieces: list[str]) -> bytes:
        """Encode with a memo of this text's pieces alone, which becomes the new cache if it is small."""
        memo: dict[str, bytes] = {}
        out = []
        for p in pieces:
            if p not in memo:
                memo[p] = self.ids(p)
            out.append(memo[p])
        if len(memo) < CACHE_PIECES // 2:
            self.known.update(memo)
        return b"".join(out)

    def offsets(self, text: str) -> list[tuple[int, int, int]]:
        """(id, start, end) in code points of the text. A token that holds part
        of a character spans the whole character."""
        out, at = [], 0
        for p in self.pieces(text):
            # Character index of each byte of the piece.
            owner = [i for i, c in enumerate(p) for _ in range(len(c.encode()))]
            for i, a, b in self.tokens(p):
                out.append((i, at + owner[a], at + owner[b - 1] + 1))
            at += len(p)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.table
        return b"".join([table[i] for i in ids.tolist()])


@lru_cache(maxsize=4)
def codec(ranks: str = RANKS, model: str = MODEL) -> Codec:
    """One codec per Python worker and vocabulary."""
    return Codec(ranks, model)


class CharacterDecoder:
    """Text of a token stream; characters split over tokens come with their last token."""

    def __init__(self, coder: Codec) -> None:
        self.coder = coder
        self.rest = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, token: int) -> str:
        return self.rest.decode(self.coder.table[token])

    def end(self) -> str:
        return self.rest.decode(b"", final=True)


def _texts(col: pa.Array) -> Iterator[str]:
    for t in col:
        yield t.as_py() or ""


def _parts(b: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about PART_BYTES of the texts in column ``at``, so that ids
    of few texts are held at a time, here and in the JVM that reads them."""
    sizes = pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // PART_BYTES
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
    for i, j in zip(edges, edges[1:]):
        yield b.slice(i, j - i)


def encode(docs: DataFrame, ids_col: str = "ids", text_col: str = "text", ranks: str = RANKS, model: str = MODEL) -> DataFrame:
    """``docs`` with a binary column of its texts' ids (little-endian unsigned 32-bit).

    A null or empty text has no ids (empty binary). An existing column of that
    name is replaced; all other columns and rows are kept as they are.
    """
    keep = [c for c in docs.columns if c != ids_col]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks, model)
        for b in (x for whole in batches for x in _parts(whole, keep.index(text_col))):
            ids = pa.array([coder.encode(t) for t in _texts(b.column(keep.index(text_col)))], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*keep, ids_col])

    return docs.select(*keep).mapInArrow(run, schema)


def digests(docs: DataFrame, with_ids: bool = False, ranks: str = RANKS, model: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode every text, decode the
    ids again. ``with_ids`` adds the ids (binary, little-endian unsigned 32-bit).

    A null or empty text has no tokens; its digests are those of no bytes.
    Repeated rows and ids give a row each; an empty table gives no rows.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(ranks, model)
        for b in (x for whole in batches for x in _parts(whole, 1)):
            n, ids_sha, text_sha, kept = [], [], [], []
            for t in _texts(b.column(1)):
                ids = coder.encode(t)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(coder.decode(np.frombuffer(ids, "<u4"))).hexdigest())
                kept += [ids] * with_ids
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * with_ids, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
