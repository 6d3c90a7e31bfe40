"""The manifest against trees built one node at a time."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import pytest

from tallymart.llm import merkle
from tallymart.llm.ranks import in_ranges

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row: dict) -> str:
    parts = []
    for field in FIELDS:
        value = row[field]
        parts.append("-" if value is None else f"{len(str(value).encode())}:{value}")
    return sha("".join(parts))


class Tree:
    """All nodes by level, the siblings of a leaf up to the root."""

    def __init__(self, leaves: list[str]):
        self.levels = [leaves]
        while len(self.levels[-1]) > 1:
            nodes = self.levels[-1]
            self.levels.append([sha("".join(nodes[k : k + 8])) for k in range(0, len(nodes), 8)])
        self.root = self.levels[-1][0]

    def path(self, at: int) -> list[tuple[list[str], list[str]]]:
        out = []
        for nodes in self.levels[:-1]:
            start = at // 8 * 8
            out.append((nodes[start:at], nodes[at + 1 : start + 8]))
            at //= 8
        return out


def brute(rows: list[dict]) -> list[tuple]:
    langs = sorted({r["lang"] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    held = {}
    for lang in langs:
        own = [(r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r) for r in rows if r["lang"] == lang]
        own.sort(key=lambda x: x[:3])
        held[lang] = own, Tree([x[2] for x in own])
    top = Tree([held[lang][1].root for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        own, tree = held[lang]
        for at, (_, _, digest, row) in enumerate(own):
            path = tree.path(at) + top.path(k)
            proof = sha("".join("".join(left + right) for left, right in path))
            found = digest
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
                text = row["text"] and re.sub("[A-Z]", lambda m: m[0].lower(), row["text"])
                found = leaf(row | {"text": text})
            for left, right in path:
                found = sha("".join([*left, found, *right]))
            out.append((row["doc_id"], digest, tree.root, top.root, proof, found, found == top.root))
    return out


def got(docs) -> Counter:
    return Counter(tuple(r) for r in merkle.manifest(docs).collect())


def want(docs) -> Counter:
    return Counter(brute([r.asDict() for r in docs.select(*FIELDS).collect()]))


def test_documents_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    found = got(docs)
    assert found == want(docs)
    verified = sum(n for row, n in found.items() if row[-1])
    assert 0 < verified < found.total()


@pytest.mark.parametrize("rows", [1, 8, 9, 512, 513, 520, 4096, 4097, 4700, 32_800])
def test_sizes(spark, rows):
    """Up to two rounds of blocks, the last subtree full, ragged, or of one block."""
    docs = spark.range(rows).selectExpr(
        "id * 7 AS doc_id", "'s' AS source", "'en' AS lang", "id AS n_chars", "concat('Text ', id) AS text"
    )
    assert got(docs) == want(docs)


def test_many_trees(spark):
    """More trees than a block of the upper tree has, one of them with a third of all rows."""
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "CAST(NULL AS string) AS source",
        "CASE WHEN id % 3 > 0 THEN concat('l', id % 1400) WHEN id % 9 > 0 THEN 'hot' END AS lang",
        "id AS n_chars", "'' AS text",
    )
    assert got(docs) == want(docs)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None, 1),
        (None, None, None, None, None, 1),
        (None, "", "", 0, "", 2),
        (5, "A", "en", 3, "ABC", 3),
        (5, "A", "en", 3, "ABC", 3),
        (5, "A", "en", 3, "abc", 3),
        (-7, "é", "é", 2, "ÉA" * 50_000, 4),
        (7, "é", "Z", 2, None, 4),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, source string, lang string, n_chars long, text string, leaf int"
    ).selectExpr("*", "leaf AS tree", "leaf AS `rank`", "leaf AS `a.b`", "leaf AS block")
    assert got(docs) == want(docs)
    assert merkle.manifest(docs.limit(0)).count() == 0


def test_equal_rows_are_cut(spark):
    """A third of all rows equal in every column does not stay in one partition."""
    docs = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 > 0 THEN id ELSE 1 END AS doc_id", "'s' AS source", "'en' AS lang", "1L AS n_chars", "'x' AS text"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = in_ranges(docs.selectExpr("lang AS tree", "doc_id", "text AS leaf"), ["tree", "doc_id", "leaf"])
        parts = [r["count"] for r in placed.where("doc_id = 1").groupBy("_part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(parts) == 10_001 and max(parts) < 6000
    assert got(docs) == want(docs)
