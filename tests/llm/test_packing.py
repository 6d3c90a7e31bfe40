"""Best-fit packing: the rules of a packing, and its size against first fit."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallymart.llm import bpe, packing, queries

JSON = public_tokenizers.path("byte_bpe_50k.json")


def first_fit(lengths: list[int], capacity: int) -> int:
    gaps: list[int] = []
    for k in sorted(lengths, reverse=True):
        at = next((i for i, g in enumerate(gaps) if g >= k), None)
        if at is None:
            gaps.append(capacity - k)
        else:
            gaps[at] -= k
    return len(gaps)


def test_plan_uses_every_piece_and_few_sequences():
    rng = random.Random(4)
    for capacity in (1, 7, 64, 300):
        for n in (0, 1, 5, 60, 400):
            lengths = [min(capacity, 1 + int(rng.paretovariate(0.7) * 3)) for _ in range(n)]
            made = packing.plan(Counter(lengths), capacity)
            used = Counter()
            for chosen, times in made:
                assert sum(chosen) <= capacity
                used += Counter({k: m * times for k, m in Counter(chosen).items()})
            assert used == Counter(lengths)
            assert sum(times for _, times in made) <= first_fit(lengths, capacity) + 1


def test_exact_complements_are_found():
    # Pair and triple sums that first fit would miss.
    made = packing.plan({6: 2, 4: 1, 3: 2, 2: 3, 1: 0}, 12)
    assert sum(t for _, t in made) == 3
    made = packing.plan({70: 10, 16: 20, 13: 10, 1: 10}, 100)
    assert sum(t for c, t in made if sum(c) == 100) >= 10


def test_cut():
    assert packing.cut(2048, 2048) == [(0, 2048)]
    assert packing.cut(2049, 2048) == [(0, 1), (1, 2048)]
    assert packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)]


def check(frame, got, capacity):
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    want = Counter()
    for r in frame.select("doc_id", "text").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (start, length) in enumerate(packing.cut(len(ids), capacity)):
            want[r.doc_id, k, start, length, zlib.crc32(ids[start : start + length])] += 1
    assert want == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in got]
    assert len(held) <= first_fit(lengths, capacity) + 1


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs, packing.pack(docs, JSON).collect(), 2048)


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, None, 1), (1, "", 2), (1, "", 2), (2, "ä b " * 9000, None),
            (3, "<|endoftext|>", 1)] + [(k, "word " * k, 1) for k in range(10, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    check(docs, packing.pack(docs, JSON, capacity=64).collect(), 64)
    assert packing.pack(docs.limit(0), JSON).count() == 0


def test_added_tokens_as_the_library_loads_them(spark, tmp_path):
    texts = ["ab <|endoftext|> cd", "<|endoftext|>", "<|endoftext|><|endoftext|>", " <|endoftext|>\n", "é  <|endoftext|>  漢",
             "<|endoftext|", "<<|endoftext|>>", "a" * 90 + "<|endoftext|>" + " b" * 90, "plain"]
    library = Tokenizer.from_file(JSON)
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert want[0] == [397, 220, 50256, 22927]
    encoder = bpe.Encoder(bpe.Vocabulary.from_json(JSON, special=True))
    encoded = list(encoder.encode(texts))
    assert [ids.tolist() for ids in encoded] == list(want.values())
    assert [encoder.vocabulary.decode(ids).decode() for ids in encoded] == texts
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    for got in (queries.op10_best_fit_packing(spark, str(tmp_path)), corpus_pipeline.best_fit_packing(spark, rows, "")):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in got.collect()} == {
            i: (len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for i, ids in want.items()
        }
