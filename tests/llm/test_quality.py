"""Quality rules against brute force."""

from __future__ import annotations

import re
from collections import Counter

from tallymart.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    n, chars = len(words), sum(map(len, words))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    dups, stutters = len(lines) - len(set(lines)), sum(a == b for a, b in zip(words, words[1:]))
    failed = n < 20 or 100 * len(covered) > 30 * n
    kept = not (
        failed or 10 * symbols > n or 2 * dups > len(lines) or 5 * stutters > n
        or chars < 2 * n or chars > 40 * n
    )
    return n, chars, symbols, dups, len(covered), failed, kept


def check(docs):
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted((tuple(r) for r in quality.report(docs).collect()), key=str) == want
    kept = sorted((w[0] for w in want if w[-1]), key=str)
    assert sorted((r.doc_id for r in quality.keep_good(docs).collect()), key=str) == kept


def test_documents_against_brute_force(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_odd_rows(spark):
    run = " ".join(f"w{i}" for i in range(12))
    rows = [
        (1, None, 1), (2, "", 1), (None, " \n\t ", 1), (3, f"{run} x {run} y {run}", 1),
        (3, f"{run} x {run} y {run}", 1), (4, "a b c d e f g h " * 4000, None),
        (5, "é" * 3 + " |  # \x0b b\x0cc\r\nd", 1), (6, "same line\n" * 40, 1),
        (7, "go go go go go stop end now " * 1 + " ".join(f"z{i}" for i in range(20)), 1),
        (8, " ".join(f"word{i}" for i in range(30)), 1), (9, "x" * 5000, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    check(docs)
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.report(docs.limit(0)).count() == 0
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_the_order_does_not_change_the_verdict(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = [*quality.BASE_RULES, *quality.MORE_RULES]
    kept = []
    for order in (rules, rules[::-1]):
        frame = quality.cascade(quality.prepared(docs, "text", ["doc_id"]), order)
        rows = frame.where("failed_rule is null").select("_doc.doc_id").collect()
        kept.append(sorted(r.doc_id for r in rows))
    assert kept[0] == kept[1]
    assert len(quality.by_rejection_per_cost(docs, "text", rules)) == len(rules)
