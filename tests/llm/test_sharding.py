"""Rendezvous sharding against brute force."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

from tallymart.llm import sharding


def bid(key, shard: int, weight: float = 1.0) -> float:
    digest = hashlib.md5(f"{shard}:{'null' if key is None else key}".encode()).hexdigest()
    return -math.log((int(digest[:13], 16) + 0.5) / 16**13) / weight


def check(docs, weights, got):
    rows = docs.select("doc_id", "text").collect()
    want = Counter()
    for r in rows:
        data = (r.text or "").encode()
        shards = [
            min(range(n), key=lambda s: bid(r.doc_id, s, ([*weights, 1.0])[s]))
            for n in (len(weights), len(weights) + 1)
        ]
        want[r.doc_id, len(data) + 16, zlib.crc32(data), "key", *shards] += 1
    assert want == Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sharding.assign(docs).collect()
    check(docs, [1.0] * 40, got)
    assert all(r.grown_shard in (r.shard, 40) for r in got)


def test_weights_and_growth(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "'x' as text")
    got = sharding.assign(docs, weights=[1.0, 2.0, 3.0], next_weight=2.0).collect()
    share = Counter(r.shard for r in got)
    assert all(abs(share[s] / 1000 - (s + 1)) < 0.25 for s in range(3))
    moved = [r for r in got if r.grown_shard != r.shard]
    assert all(r.grown_shard == 3 for r in moved) and abs(len(moved) / 1500 - 1) < 0.15


def test_odd_rows(spark):
    rows = [(None, None, 1), (None, None, 1), (1, "", 2), (1, "", 2), (1, "é" * 9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    check(docs, [1.0] * 40, sharding.assign(docs).collect())
    assert sharding.assign(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_cut(spark):
    """A third of all rows on one id are in one shard, but numbered in many groups."""
    docs = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS doc_id", "concat('t', id) AS text")
    got = sharding.assign(docs).collect()
    check(docs, [1.0] * 40, got)
    key = [(r.text_crc32, r.size) for r in docs.sparkSession.createDataFrame(got).where("doc_id = 5").collect()]
    buckets = {
        int(hashlib.md5(f"bucket:5:{crc}:{size}".encode()).hexdigest()[:13], 16) % 256 for crc, size in key
    }
    assert len(key) > 1990 and len(buckets) > 240
