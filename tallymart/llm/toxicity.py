"""Toxic spans by a linear-chain conditional random field.

Labels are per document, so tokens are labelled at a distance: features of a word
(the word, and its beginnings of a few lengths) that occur far more often in toxic
documents than in others make the lexicon, and a token of a toxic document is
labelled toxic if one of its features is nearly confined to such documents.

The field has two states and weights for the lexicon's features, a bias and the
transitions.  It is trained on the windows around tokens with a feature.  At
scoring, forward-backward runs over whole texts: a run of tokens without features
is a power of one matrix, so only the others cost time.  A document's score is a
logistic function of its tokens' marginals; the offending offsets are the tokens
whose marginal is at least 0.5.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import store
from .batched import by_document, fold, keep_rows, least_hashed, lowered, sampled

#: Bounds of the fit: labelled rows of each class, features of the lexicon.
TRAIN_ROWS, LEXICON = 5000, 3000
BEGINNINGS = (3, 4, 5, 6, 7)
WINDOW = 2  # tokens on either side
NEAREST = 0.9  # share of toxic documents, at equal class sizes, that labels a token
LIMIT = 0.7  # of the score, from which a document counts as toxic
TOKEN = re.compile(r"\w+")
_REACH = 4096  # longer runs without features have forgotten where they began


def features(word: str) -> list[str]:
    """The word with an end mark, and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


class _Values(dict):
    """Emission of each word, worked out when it is first met; 0 without features."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value


@dataclass
class Field:
    """Weights of the toxic state by feature, its bias, and the transitions."""

    weights: dict[str, float]
    bias: float
    transitions: np.ndarray  # [from, to]

    def __post_init__(self):
        step = np.exp(self.transitions) * np.exp([0.0, self.bias])
        self.powers = np.zeros((_REACH, 2, 2))
        power = np.eye(2)
        for k in range(_REACH):  # only directions matter, so each power is scaled
            self.powers[k] = power
            power = power @ step
            power /= power.max()
        # Numbers of Python, for short loops over single tokens.
        self.steps = [tuple(p.ravel().tolist()) for p in self.powers]
        self.move = tuple(np.exp(self.transitions).ravel().tolist())

    def marginals(self, values: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
        """P(toxic) of the tokens at ``places``, which have these emissions, among ``size``."""
        gaps = np.minimum(np.diff(np.r_[-1, places, size]) - 1, _REACH - 1).tolist()
        m00, m01, m10, m11 = self.move
        raised = np.exp(np.clip(values + self.bias, -50, 50)).tolist()
        forward, a, b = [], 1.0, 1.0
        for gap, e in zip(gaps, raised, strict=False):
            if forward or gap:  # a first token has no transition into it
                p00, p01, p10, p11 = self.steps[gap if forward else max(gap - 1, 0)]
                if not forward:
                    b *= np.exp(min(max(self.bias, -50.0), 50.0))
                a, b = a * p00 + b * p10, a * p01 + b * p11
                a, b = a * m00 + b * m10, (a * m01 + b * m11) * e
            else:
                b *= e
            total = a + b
            a, b = a / total, b / total
            forward.append((a, b))
        out = np.empty(len(forward))
        p00, p01, p10, p11 = self.steps[gaps[-1]]
        a, b = p00 + p01, p10 + p11  # what follows, seen from the last token
        for k in range(len(forward) - 1, -1, -1):
            fa, fb = forward[k]
            out[k] = fb * b / (fa * a + fb * b)
            if k:
                e = raised[k]
                a, b = m00 * a + m01 * b * e, m10 * a + m11 * b * e
                p00, p01, p10, p11 = self.steps[gaps[k]]
                a, b = p00 * a + p01 * b, p10 * a + p11 * b
                total = a + b
                a, b = a / total, b / total
        return out


def trained(windows: Counter, known: list[str], rounds: int = 150) -> Field:
    """Maximum likelihood with a ridge, by Adam, over (features, labels) windows with counts."""
    length = 2 * WINDOW + 1
    index = {f: k for k, f in enumerate(known)}
    cells, hits, labels, weight = [], [], [], []
    for n, ((feats, marks), times) in enumerate(sorted(windows.items())):
        for place, own in enumerate(feats):
            cells += [n * length + place] * len(own)
            hits += [index[f] for f in own]
        labels.append(marks)
        weight.append(times)
    cells, hits = np.array(cells, int), np.array(hits, int)
    y = np.array(labels, float)
    share = np.array(weight, float) / sum(weight)
    size = len(known)
    x = np.zeros(size + 5)
    x[size] = -2.0
    m1, m2 = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, rounds + 1):
        w, bias, move = x[:size], x[size], x[size + 1 :].reshape(2, 2)
        toxic = (np.bincount(cells, w[hits], y.size) + bias).reshape(y.shape)
        emission = np.stack([np.zeros_like(toxic), toxic], 2)
        front = np.zeros_like(emission)
        back = np.zeros_like(emission)
        front[:, 0] = emission[:, 0]
        for k in range(1, length):
            front[:, k] = emission[:, k] + np.logaddexp.reduce(front[:, k - 1, :, None] + move, 1)
        for k in range(length - 2, -1, -1):
            back[:, k] = np.logaddexp.reduce(move + (emission[:, k + 1] + back[:, k + 1])[:, None, :], 2)
        total = np.logaddexp.reduce(front[:, -1], 1)
        p = np.exp(front[:, :, 1] + back[:, :, 1] - total[:, None])
        off = (y - p) * share[:, None]
        gradient = np.zeros_like(x)
        gradient[:size] = np.bincount(hits, off.ravel()[cells], size)
        gradient[size] = off.sum()
        for k in range(1, length):
            both = (
                front[:, k - 1, :, None] + move + (emission[:, k] + back[:, k])[:, None, :]
                - total[:, None, None]
            )
            expected = (np.exp(both) * share[:, None, None]).sum(0)
            was = np.stack([1 - y[:, k - 1], y[:, k - 1]], 1)
            now = np.stack([1 - y[:, k], y[:, k]], 1)
            seen = (was[:, :, None] * now[:, None, :] * share[:, None, None]).sum(0)
            gradient[size + 1 :] += (seen - expected).ravel()
        gradient -= 1e-5 * x
        m1 = 0.9 * m1 + 0.1 * gradient
        m2 = 0.99 * m2 + 0.01 * gradient**2
        x = x + 0.15 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
    return Field(dict(zip(known, x[:size].tolist(), strict=True)), float(x[size]), x[size + 1 :].reshape(2, 2))


@dataclass
class Model:
    field: Field | None
    coefficients: np.ndarray

    def described(self, texts: list[str]) -> Iterator[tuple[np.ndarray, list[int], np.ndarray]]:
        """Of each text: what the score is made of, the places of tokens, their marginals."""
        values = _Values(self.field.weights if self.field else {})
        for text in texts:
            tokens = TOKEN.findall(lowered(text))
            emission = np.fromiter(map(values.__getitem__, tokens), float, len(tokens))
            places = np.flatnonzero(emission)
            if not len(places):
                yield np.array([1.0, 0.0, 0.0, 0.0]), [], np.zeros(0)
                continue
            p = self.field.marginals(emission[places], places, len(tokens))
            told = np.array([1.0, p.max(), np.log1p(p.sum()), np.sqrt(p.sum() / len(tokens))])
            yield told, places, p

    def score(self, texts: list[str]) -> Iterator[tuple[float, str]]:
        """The score, and the code points start:end of offending tokens, comma-joined."""
        for text, (told, places, p) in zip(texts, self.described(texts), strict=True):
            bad = set(np.asarray(places)[p >= 0.5].tolist()) if len(p) else ()
            spans = (
                [f"{m.start()}:{m.end()}" for k, m in enumerate(TOKEN.finditer(lowered(text))) if k in bad]
                if bad
                else []
            )
            linear = float(np.clip(told @ self.coefficients, -30, 30))
            yield (1 / (1 + np.exp(-linear)) if self.field else 0.0), ",".join(spans)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the first column is the constant."""
    c = np.zeros(x.shape[1])
    keep = ridge * weight.sum() * np.eye(x.shape[1])
    keep[0, 0] = 1e-9 * weight.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        slope = x.T @ (weight * (y - p)) - keep @ c
        bend = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + keep
        move = np.linalg.solve(bend, slope)
        c = c + move * min(1.0, 5 / max(np.abs(move).max(), 1e-9))
    return c


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, folds: int, held_fold: int
) -> Model:
    """A model from TRAIN_ROWS labelled documents of each class outside the held-out fold.

    Copies and near copies (equal least hash of their word triples) count once.
    Null ids, texts and labels teach nothing; a document with both labels is toxic.
    """
    marked = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
        .where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), folds) != held_fold))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # Ids are chosen before texts are joined, so no text of another document moves.
    marked = marked.join(docs.select(F.col(doc_id).alias("doc_id")).distinct(), "doc_id")
    whole = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    chosen = least_hashed(marked, "toxic", "doc_id", TRAIN_ROWS, whole)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # ``chosen`` has at most TRAIN_ROWS rows of each class; its ids may have many texts.
    rows = rows.where("text is not null").join(F.broadcast(chosen), "doc_id")
    sample = sampled(rows, "toxic", TRAIN_ROWS, dict.fromkeys(whole, TRAIN_ROWS))
    split = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    triples = sample.withColumn("words", split).withColumn(
        "sketch",
        F.coalesce(
            F.array_min(
                F.transform(
                    F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0))),
                    lambda i: F.xxhash64(
                        F.get(F.col("words"), i), F.get("words", i + 1), F.get("words", i + 2)
                    ),
                )
            ),
            F.lit(0),
        ),
    )
    single = triples.groupBy("toxic", "sketch").agg(F.min(F.struct("key", "text")).alias("one"))
    sample = store(
        single.select("toxic", F.concat_ws(":", "one.key", "toxic").alias("id"), "one.text"), "labelled"
    )
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Model(None, np.zeros(4))

    def found(texts: list[str]) -> Iterator[tuple]:
        for t in texts:
            yield (sorted({f for w in set(TOKEN.findall(lowered(t))) for f in features(w)}),)

    lexicon = _lexicon(by_document(sample, "id", "text", found, "features array<string>"), sizes)
    if not lexicon:
        return Model(None, np.zeros(4))
    near = {f for f, (a, b) in lexicon.items() if a / sizes[1] >= NEAREST * (a / sizes[1] + b / sizes[0])}
    held = frozenset(lexicon)

    def windows(texts: list[str]) -> Iterator[tuple]:
        """Features of the tokens around each token that has some, and how many have none."""
        for t in texts:
            tokens = TOKEN.findall(lowered(t))
            own = {w: [f for f in features(w) if f in held] for w in set(tokens)}
            per = [own[w] for w in tokens]
            out = []
            for k, feats in enumerate(per):
                if feats:
                    around = [per[i] if 0 <= i < len(per) else [] for i in range(k - WINDOW, k + WINDOW + 1)]
                    out.append("\x01".join("\x02".join(f) for f in around))
            yield out, len(tokens) - len(out)

    counted: Counter = Counter()
    empty = ((),) * (2 * WINDOW + 1)
    told = by_document(sample, "id", "text", windows, "windows array<string>, plain long")
    told = told.withColumn("toxic", F.substring_index("doc_id", ":", -1).cast("int"))
    groups = (
        told.select("toxic", F.explode("windows").alias("window"))
        .groupBy("toxic", "window").agg(F.count("*").alias("n"))
    )
    for r in groups.toLocalIterator():
        feats = tuple(tuple(p.split("\x02")) if p else () for p in r["window"].split("\x01"))
        marks = tuple(int(r["toxic"] == 1 and not near.isdisjoint(f)) for f in feats)
        counted[feats, marks] += r["n"]
    plain = told.agg(F.sum("plain")).first()[0] or 0
    counted[empty, (0,) * len(empty)] += min(plain // len(empty) + 1, 10 * sum(counted.values()))
    model = Model(trained(counted, sorted(lexicon)), np.zeros(4))
    scored = by_document(
        sample, "id", "text", lambda texts: ((t.tolist(),) for t, _, _ in model.described(texts)),
        "told array<double>",
    )
    rows = sorted((r["doc_id"], r["told"]) for r in scored.collect())
    x = np.array([t for _, t in rows])
    y = np.array([float(i.rsplit(":", 1)[1]) for i, _ in rows])
    weight = np.where(y == 1, whole[1] / sizes[1], whole[0] / sizes[0])
    return Model(model.field, logistic(x, y, weight))


def _lexicon(described: DataFrame, sizes: dict[int, int]) -> dict[str, tuple[int, int]]:
    """The features that tell most, with the toxic and other documents that have them.

    Kept are features of at least 2 % of the toxic documents (3 at least), 4 times as
    frequent there, with log odds at least 3 standard deviations above 0; at most
    LEXICON of them.
    """
    toxic = F.col("doc_id").endswith(":1")
    a, b = F.col("a"), F.col("b")
    one, zero = float(sizes[1]), float(sizes[0])
    odds = F.log((a + 0.5) / (F.lit(one) - a + 0.5)) - F.log((b + 0.5) / (F.lit(zero) - b + 0.5))
    z = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    counts = (
        described.select(toxic.alias("toxic"), F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    )
    kept = counts.where((a >= max(3.0, 0.02 * one)) & ((a + 0.5) / one >= 4 * (b + 0.5) / zero) & (z >= 3))
    best = kept.orderBy((z * F.sqrt(a)).desc(), "feature").limit(LEXICON)
    return {r["feature"]: (r["a"], r["b"]) for r in best.collect()}


def scored(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    folds: int = 3,
    held_fold: int = 1,
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans.

    Empty and null texts get the score of a text without toxic tokens; without
    labels of both classes all scores are 0.  A null id is held out.  Repeated
    rows are kept.  Of features that tell equally much the first by name is learned.
    """
    model = train(docs, labels, doc_id, text, toxic, folds, held_fold)
    out = by_document(docs, doc_id, text, model.score, "score double, spans string")
    held = F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(True))
    return out.select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"), "spans",
    )


def keep_clean(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    folds: int = 3,
    held_fold: int = 1,
) -> DataFrame:
    """The documents whose score is under the limit, with the columns of ``docs``.

    Null and empty texts score as a text without toxic tokens; equal texts stay or go
    together, repeated rows stay repeated.  No rows give none.
    """
    model = train(docs, labels, doc_id, text, toxic, folds, held_fold)
    return keep_rows(docs, text, lambda texts: [score < LIMIT for score, _ in model.score(texts)])
