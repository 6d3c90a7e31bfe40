"""Byte-level BPE against the libraries that use the same vocabularies."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tallymart.llm import bpe

RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
ALPHABET = [
    "a", " ", "  ", "\n", "\t", "é", "1", "²", "'s", "'", "ß", "漢", "😀", "​", "\x85", "\xa0",
    "\x1c", "the", "ing", "aaaa", "!!", "<|endoftext|>", "\0", "٣", " ", "Ⅷ",
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def odd_texts() -> list[str]:
    rng = random.Random(1)
    return ["".join(rng.choices(ALPHABET, k=rng.randrange(40))) for _ in range(4000)]


def test_odd_texts_as_the_libraries_encode_them(library):
    texts = odd_texts()
    ranked = bpe.Encoder(bpe.Vocabulary.from_ranks(RANKS))
    for text, ids in zip(texts, ranked.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text)
        assert ranked.vocabulary.decode(ids) == text.encode()
    other = Tokenizer.from_file(JSON)
    other.encode_special_tokens = True
    want = other.encode_batch(texts, add_special_tokens=False)
    got = bpe.Encoder(bpe.Vocabulary.from_json(JSON)).encode(texts)
    assert [ids.tolist() for ids in got] == [w.ids for w in want]


def test_earlier_ranks_that_arise_late():
    """Merging b and c makes a pair whose rank is lower; the piece is then done alone."""
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ca"]
    merges = np.array([(97, 257, 256, 256), (98, 99, 257, 257), (99, 97, 258, 258)])
    vocabulary = bpe.Vocabulary(tokens, merges, False)
    rng = random.Random(2)
    pieces = [bytes(rng.choices(b"abc", k=rng.randrange(12))) for _ in range(500)]
    flat, starts, sizes = vocabulary.replay(pieces)
    for piece, a, n in zip(pieces, starts, sizes, strict=True):
        assert flat[a : a + n].tolist() == vocabulary.one_by_one(piece)


def test_documents(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(None, None, 1), (-1, "", 1), (-1, "", 1), (-2, "é " * 60_000, 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    for frame in (docs, odd):
        want = []
        for r in frame.select("doc_id", "text").collect():
            ids = library.encode_ordinary(r.text or "")
            sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            want.append((r.doc_id, len(ids), sha, hashlib.sha256((r.text or "").encode()).hexdigest()))
        got = bpe.digests(frame, RANKS)
        assert got.schema["doc_id"].dataType == frame.schema["doc_id"].dataType
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert bpe.digests(odd.limit(0), RANKS).count() == 0


def test_batches_of_any_size(library):
    """Words that need no pattern, and others, alone and many together."""
    texts = odd_texts()[:1500] + ["the token the token again " * 3, "aaaa" * 100 + " y", "Straße élan", " x", "naïve ɐ"]
    encoder = bpe.Encoder(bpe.Vocabulary.from_ranks(RANKS))
    for most in (300, 10**9):
        for part in bpe.batches(texts, most=most):
            for text, ids in zip(texts[part], encoder.encode(texts[part]), strict=True):
                assert ids.tolist() == library.encode_ordinary(text)


def test_added_tokens_in_many_batches():
    other = Tokenizer.from_file(JSON)
    encoder = bpe.Encoder(bpe.Vocabulary.from_json(JSON, special=True))
    for text in ["ab <|endoftext|> cd", "<|endoftext|>", " cd<|endoftext|>ab cd"]:
        (ids,) = encoder.encode([text])
        assert ids.tolist() == other.encode(text, add_special_tokens=False).ids
