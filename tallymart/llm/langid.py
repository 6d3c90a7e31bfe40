"""Language identification by a string kernel.

The kernel of two texts is the number of character n-grams (1 to ORDER, lower
case) that occur in both, divided by the root of the product of their numbers of
n-grams.  N-grams are hashed into 2^BITS buckets.  Nystroem: every text is
described by its kernels with a few landmark texts, and kernel ridge regression,
one language against the rest, is solved in that space.

A text's score is its row of presences times the landmarks' presences times the
coefficients; the last two are multiplied once, so a batch of texts is scored by
one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batched import by_document, fold, sampled

ORDER, BITS = 4, 18
#: Bounds of the fit: training rows and landmarks of each of up to LANGUAGES languages;
#: more languages share the rows and landmarks of so many, at least one each.
TRAIN_ROWS, LANDMARKS, LANGUAGES = 400, 60, 100
RIDGE = 1e-3
BATCH = 64
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """The distinct buckets of the text's n-grams, sorted."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    present = np.zeros(1 << BITS, bool)
    running = np.zeros(len(points) + 1, np.uint32)
    for order in range(1, ORDER + 1):
        if len(points) < order:
            break
        running = running[:-1] * np.uint32(0x01000193) ^ points[order - 1 :]
        mixed = (running + np.uint32(order)) * np.uint32(2654435769)
        present[mixed >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(present)


@dataclass
class Model:
    languages: list[str]
    buckets: np.ndarray  # bucket -> row of weights, -1 where no landmark has it
    weights: np.ndarray  # float32, a column per language

    def scores(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ridge scores of each text, by batches."""
        for start in range(0, len(texts), BATCH):
            found = [grams(t) for t in texts[start : start + BATCH]]
            rows = np.zeros((len(found), len(self.weights)), np.float32)
            for k, own in enumerate(found):
                known = self.buckets[own]
                rows[k, known[known >= 0]] = 1 / np.sqrt(max(len(own), 1))
            yield from rows @ self.weights

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        if not self.languages:
            yield from ((UNKNOWN, 0.0) for _ in texts)
            return
        for text, score in zip(texts, self.scores(texts), strict=True):
            if any(c.isalpha() for c in text):
                share = np.exp(4 * (score - score.max()).astype(float))
                best = int(score.argmax())
                yield self.languages[best], float(share[best] / share.sum())
            else:
                yield UNKNOWN, 0.0


def fitted(presences: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS) -> Model:
    """Kernel ridge regression over landmarks from (language, buckets) of the training texts."""
    presences = [(lang, own) for lang, own in presences if len(own)]
    languages = sorted({lang for lang, _ in presences})
    of = {lang: [] for lang in languages}
    for lang, own in presences:
        of[lang].append(own)
    marks = [own for lang in languages for own in of[lang][:landmarks]]
    if not marks:
        return Model([], np.full(1 << BITS, -1, np.int32), np.zeros((0, 0), np.float32))
    used = np.unique(np.concatenate(marks))
    buckets = np.full(1 << BITS, -1, np.int32)
    buckets[used] = np.arange(len(used))
    held = np.zeros((len(marks), len(used)), np.float32)
    for k, own in enumerate(marks):
        held[k, buckets[own]] = 1 / np.sqrt(len(own))
    kernel = np.zeros((len(presences), len(marks)))
    for start in range(0, len(presences), BATCH):
        part = presences[start : start + BATCH]
        rows = np.zeros((len(part), len(used)), np.float32)
        for k, (_, own) in enumerate(part):
            known = buckets[own]
            rows[k, known[known >= 0]] = 1 / np.sqrt(len(own))
        kernel[start : start + len(part)] = rows @ held.T
    between = (held @ held.T).astype(float)
    goal = np.array([[1.0 if lang == la else -1.0 for la in languages] for lang, _ in presences])
    # Every language weighs alike, however many rows it has.
    weight = np.array([1 / len(of[lang]) for lang, _ in presences])[:, None]
    system = kernel.T @ (weight * kernel) + RIDGE * between + 1e-9 * np.eye(len(marks))
    coefficients = np.linalg.solve(system, kernel.T @ (weight * goal))
    return Model(languages, buckets, (held.T @ coefficients).astype(np.float32))


def train(
    docs: DataFrame, doc_id: str, text: str, lang: str, folds: int = 5, held_fold: int = 0
) -> Model:
    """A model of all languages from a bounded sample: TRAIN_ROWS texts of each, fewer where there
    are more than LANGUAGES, of documents outside the held-out fold; null ids, texts and languages
    teach nothing."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.col(lang).cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), folds) != held_fold))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return fitted([])
    each = lambda most: max(1, min(most, most * LANGUAGES // len(sizes)))
    sample = sampled(rows, "lang", each(TRAIN_ROWS), sizes)
    described = by_document(
        sample.withColumn("id", F.concat_ws(":", F.col("key").cast("string"), "lang")), "id", "text",
        lambda texts: ((grams(t).astype(np.int32).tobytes(),) for t in texts), "grams binary",
    )
    found = sorted((r["doc_id"].split(":", 1), r["grams"]) for r in described.collect())
    presences = [(lang, np.frombuffer(own, np.int32)) for (_, lang), own in found]
    return fitted(presences, each(LANDMARKS))


def predict(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    ``und`` with score 0 for a text that is null or has no letter, or if nothing
    could be learned.  Of languages with equal scores the first by name is given.  A null
    id is held out.  Repeated rows are kept.
    """
    model = train(docs, doc_id, text, lang)
    scored = by_document(docs, doc_id, text, model.predict, "lang_pred string, score double")
    held = F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(True))
    return scored.select("doc_id", held.alias("held_out"), "lang_pred", "score")
