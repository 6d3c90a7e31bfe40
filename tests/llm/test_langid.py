"""Language identification: the kernel against brute force, held-out accuracy, odd rows."""

from __future__ import annotations

import random
import zlib

import numpy as np

from tallymart.llm import langid


def test_scores_are_the_kernel_with_the_landmarks(spark):
    texts = {"x": ["abc abd", "aab cab bca"], "y": ["zyx zzy", "yxz xzy"]}
    presences = [(lang, langid.grams(t)) for lang, ts in texts.items() for t in ts]
    model = langid.fitted(presences)

    def kernel(a, b):
        return len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b))

    marks = [own for _, own in presences]
    between = np.array([[kernel(a, b) for b in marks] for a in marks])
    goal = np.array([[1, -1], [1, -1], [-1, 1], [-1, 1]], float)
    system = between.T @ (0.5 * between) + langid.RIDGE * between + 1e-9 * np.eye(4)
    coefficients = np.linalg.solve(system, between.T @ (0.5 * goal))
    asked = ["abz cab", "zzz", "q"]
    want = [[kernel(langid.grams(t), m) for m in marks] @ coefficients for t in asked]
    assert np.allclose(list(model.scores(asked)), want, atol=1e-3)


def test_grams_are_presences_of_whole_texts():
    assert len(langid.grams("")) == 0
    assert np.array_equal(langid.grams("Abab" * 5000), langid.grams("ABAB" * 3))
    assert len(langid.grams("ab")) == 3


def test_held_out_accuracy_and_folds(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    got = {r.doc_id: r for r in langid.predict(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [got[r.doc_id].lang_pred == r.lang for r in rows if got[r.doc_id].held_out]
    assert sum(held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    rows = [(None, "el perro", "es", 1), (1, None, "es", 1), (1, "123 !", "en", 1), (2, "", None, 1)]
    rows += [(k, "the cat and the dog", "en", 1) for k in range(3, 20)]
    rows += [(k, "el gato y el perro " * 400, "es", 1) for k in range(20, 40)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = langid.predict(docs).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2)} == {"und"}
    assert {r.lang_pred for r in got if r.doc_id and r.doc_id >= 20} == {"es"}
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    assert langid.predict(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.predict(docs.where("lang is null")).collect()} == {"und"}


def test_more_languages_than_the_fit_has_full_rows_for(spark):
    rng = random.Random(5)
    rows = []
    for k in range(langid.LANGUAGES + 20):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)]
        rows += [(k * 100 + i, " ".join(rng.choices(words, k=30)), f"x{k}") for i in range(12 if k else 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs).collect()}
    right = [got[i] == lang for i, _, lang in rows]
    assert {got[i] for i, _, _ in rows} == {lang for _, _, lang in rows}
    assert sum(right) > 0.98 * len(right)
