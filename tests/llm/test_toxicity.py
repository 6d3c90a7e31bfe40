"""The toxicity field: marginals against enumeration, held-out accuracy, odd rows."""

from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np

from tallymart.llm import toxicity
from tallymart.llm.batched import lowered


def enumerated(emissions, bias, move):
    """P(state 1) of each token by summing over all labellings."""
    n, total, on = len(emissions), 0.0, np.zeros(len(emissions))
    for states in itertools.product((0, 1), repeat=n):
        energy = sum((bias + e) * s for e, s in zip(emissions, states, strict=True))
        energy += sum(move[a, b] for a, b in itertools.pairwise(states))
        total += np.exp(energy)
        on += np.exp(energy) * np.array(states)
    return on / total


def test_marginals_over_runs_without_features():
    rng = random.Random(6)
    for _ in range(60):
        n = rng.randrange(1, 10)
        emissions = np.array([rng.choice([0, 0, 0, 2.5, -1.0]) for _ in range(n)])
        places = np.flatnonzero(emissions)
        if not len(places):
            continue
        move = np.array([[rng.gauss(0, 1) for _ in range(2)] for _ in range(2)])
        bias = rng.gauss(-1, 1)
        field = toxicity.Field({}, bias, move)
        got = field.marginals(emissions[places], places, n)
        assert np.allclose(got, enumerated(emissions, bias, move)[places])


def test_training_separates_labelled_windows():
    none = ()
    windows = Counter({
        ((none, none, ("bad",), none, none), (0, 0, 1, 0, 0)): 30,
        ((none, none, ("meh",), none, none), (0, 0, 0, 0, 0)): 30,
        ((none,) * 5, (0,) * 5): 200,
    })
    field = toxicity.trained(windows, ["bad", "meh"])
    p = field.marginals(np.array([field.weights["bad"], field.weights["meh"]]), np.array([3, 9]), 15)
    assert p[0] > 0.8 and p[1] < 0.2


def test_offsets_stay_under_lower_case():
    assert len(lowered("İ ABC ẞ")) == len("İ ABC ẞ")


def test_held_out_documents(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    hits = sum(p and t for p, t in held)
    assert hits / sum(t for _, t in held) > 0.75 and hits / sum(p for p, _ in held) > 0.9
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in rows:
        for span in filter(None, r.spans.split(",")):
            start, end = map(int, span.split(":"))
            assert toxicity.TOKEN.fullmatch(texts[r.doc_id][start:end])


def test_odd_rows(spark):
    bad = [(k, f"a{k} b{k} vile c{k}", "x") for k in range(100, 160)]
    good = [(k, f"d{k} e{k} fine f{k}", "x") for k in range(200, 300)]
    odd = [(None, "so vile", "x"), (None, "so vile", "x"), (1, None, None), (1, "", "x"), (2, "Vile " * 20000, "x")]
    docs = spark.createDataFrame(bad + good + odd, "doc_id long, text string, score string")
    marks = [(r[0], 1) for r in bad] + [(r[0], 0) for r in good] + [(None, 1), (7, None), (100, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == len(bad + good + odd)
    assert [r.held_out for r in rows if r.doc_id is None] == [True, True]
    assert all(r.predicted == 1 for r in rows if r.doc_id is None or 100 <= r.doc_id < 160 or r.doc_id == 2)
    assert all(r.predicted == 0 for r in rows if r.doc_id and r.doc_id >= 200 or r.doc_id == 1)
    assert {r.spans for r in rows if r.doc_id is None} == {"3:7"}
    assert {r.score for r in toxicity.scored(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), labels).count() == 0
