"""SimHash near-dedup against brute force."""

from __future__ import annotations

import random
import re

import xxhash

from tallymart.llm import near_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids: list, prints: list[int], radius: int) -> list:
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return [least.get(find(i)) for i in range(len(ids))]


def unsigned(value: int) -> int:
    return value % (1 << 64)


def test_every_pair_within_the_radius_shares_a_table():
    rng = random.Random(1)
    for radius in (1, 2, 3, 4):
        masks = near_dedup.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(500):
            bits = rng.sample(range(64), radius)
            assert any(all(not unsigned(m) >> b & 1 for b in bits) for m in masks)


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    groups = dict(zip(prints, brute_components(list(prints), list(prints.values()), 2), strict=True))
    got = near_dedup.simhash_groups(docs).collect()
    assert {r.doc_id: unsigned(r.fingerprint) for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == groups


def test_chains_link_and_edges_are_defined(spark):
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(40)]
    for start in values[:5]:  # chains of small steps, and steps one bit too far
        for step in (1, 2, 3, 2, 1):
            for bit in rng.sample(range(64), step):
                start ^= 1 << bit
            values.append(start)
    ids = [i * 7 % 101 for i in range(len(values))]
    frame = spark.createDataFrame(
        [(i, near_dedup._signed(v)) for i, v in zip(ids, values, strict=True)], "id long, f long"
    )
    for radius in (1, 2, 3):
        got = near_dedup.near_groups(frame, "f", "id", radius).collect()
        by_value = {unsigned(r.f): r.component_id for r in got}
        assert [by_value[v] for v in values] == brute_components(ids, values, radius)


def test_odd_rows(spark):
    rows = [
        (5, None, 1), (4, "", 1), (None, " \t\n", 1), (3, "one two", 1), (3, "one two", 1),
        (None, "ONE two", 2), (9, "É é " * 3000, 2), (8, "ß", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = near_dedup.simhash_groups(docs).collect()
    assert len(got) == len(rows)
    prints = [brute_fingerprint(r[1]) for r in rows]
    groups = brute_components([r[0] for r in rows], prints, 2)
    want = sorted(zip([r[0] for r in rows], prints, groups, strict=True), key=str)
    assert sorted(((r.doc_id, unsigned(r.fingerprint), r.component_id) for r in got), key=str) == want
    kept = near_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [3, 4, 8, 9]
    assert near_dedup.simhash_groups(docs.limit(0)).count() == 0
    assert near_dedup.keep_one_each(docs.limit(0)).count() == 0


def test_any_columns_come_back(spark):
    """Names that the operator might use itself, dots, quotes and maps."""
    rows = [(5, "a b c", k, f"h{k}", k * 2, {"k": k}, "q") for k in (7, 8, 9)]
    rows += [(k, f"text number {k} of some", 10 + k, None, None, None, None) for k in (1, 2)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, __nth int, __hash1 string, `a.b` int, row map<string,int>, `q``q` string"
    ).selectExpr("*", "__nth AS nth", "__nth AS hash1", "__nth AS fingerprint", "__nth AS own")
    kept = near_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    out = {tuple(map(str, r)) for r in kept.collect()}
    assert len(out) == 3 and out <= {tuple(map(str, r)) for r in docs.collect()}
