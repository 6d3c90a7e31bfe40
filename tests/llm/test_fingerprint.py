"""Fingerprints, edited texts and the search against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

from tallymart.llm import fingerprint


def order(r):
    return (r[0] is None, -(r[0] or 0), zlib.crc32((r[1] or "").encode()), r[1] or "")


def check(rows, got):
    chain = sorted(rows, key=order)
    want, texts = [], {}
    for k, r in enumerate(chain):
        text, following = r[1] or "", chain[(k + 1) % len(chain)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        want.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
        texts.setdefault((r[0], len(text), want[-1][2]), []).append((text, edited, following))
    assert sorted(want, key=str) == sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str)
    prints = {}
    for r in got:
        for text, edited, _ in texts[r.doc_id, r.n_chars, r.edited_sha256]:
            assert prints.setdefault(text, r.fingerprint) == r.fingerprint
            assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
    for r in got:
        alike = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 64
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
        nexts = {prints[t[2]] for t in texts[r.doc_id, r.n_chars, r.edited_sha256]}
        assert r.near_next in {alike(r.fingerprint, n) for n in nexts}
        if r.doc_id is not None and r.doc_id % 100 == 0:
            near = sum((int(r.fingerprint, 16) ^ int(o.fingerprint, 16)).bit_count() <= 3 for o in got)
            assert r.n_near == near - 1
        else:
            assert r.n_near is None


def test_documents_against_brute_force(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    monkeypatch.setattr(fingerprint.with_next, "__defaults__", (7, 20_000))
    check(docs.select("doc_id", "text").collect(), fingerprint.report(docs).collect())


def test_odd_rows(spark, monkeypatch):
    rows = [
        (None, "a b c d", 1), (None, None, 1), (300, "", 1), (300, "", 1), (200, "ä ö ü ß e f", 1),
        (100, "x " * 20000, 1), (7, "one", None), (7, "two words", 2),
    ]
    monkeypatch.setattr(fingerprint.with_next, "__defaults__", (2, 20_000))
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int")
    check(rows, fingerprint.report(docs).collect())
    check(rows[4:5], fingerprint.report(docs.where("doc_id = 200")).collect())
    assert fingerprint.report(docs.limit(0)).count() == 0


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:30]:
        for bits in (1, 2, 3, 4):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "f long")
    for radius, blocks in ((3, 6), (1, 3), (0, 1)):
        got = fingerprint.within_radius(frame.limit(20), frame, "f", radius, blocks).collect()
        near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count()
        want = {(a, b, near(a, b)) for a in signed[:20] for b in signed if near(a, b) <= radius}
        assert {tuple(r) for r in got} == want and len(got) == len(want)
