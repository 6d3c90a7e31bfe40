"""Each stage of the pipeline on the output of the one before it, against brute force."""

from __future__ import annotations

import os

import corpus_pipeline
from pyspark.sql import functions as F
from test_near_dedup import brute_components, brute_fingerprint
from test_packing import check as check_packing
from test_quality import brute as brute_quality
from test_secrets import base

from tallymart.llm import toxicity
from tallymart.sources.shared import store


def test_stages(spark, sf_dir):
    path = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    seen = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = seen
        if name == "toxicity":
            labels = spark.read.parquet(f"{path}/labels.parquet")
            scores = {r.doc_id: r.predicted for r in toxicity.scored(docs, labels).collect()}
        docs = store(stage(spark, docs, path), "stage")
        assert docs.columns == columns
        rows = docs.collect()
        seen = {r.doc_id: r for r in rows}
        assert len(seen) == len(rows)
        if name == "quality rules":
            assert seen == {k: r for k, r in before.items() if brute_quality(r.text)[-1]}
        elif name == "toxicity":
            assert seen == {k: r for k, r in before.items() if not scores[k]}
            assert 0.8 < len(seen) / len(before) < 1
        elif name == "near-dedup":
            prints = [brute_fingerprint(r.text) for r in before.values()]
            assert set(seen) == set(brute_components(list(before), prints, 2))
            assert all(before[k] == r for k, r in seen.items())
        else:
            assert set(seen) == set(before)
            for k, r in seen.items():
                spans, text = base(before[k].text), before[k].text
                if not spans:
                    assert r == before[k]
                else:
                    assert r.n_chars == len(r.text)
                    assert not any(text[a:b] in r.text for a, _, b, _ in spans)
    check_packing(docs, corpus_pipeline.best_fit_packing(spark, docs, path).collect(), 2048)


def test_run_is_the_stages_together(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 0
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)


def test_run_on_odd_documents(spark, sf_dir, tmp_path):
    """Nulls, repeated rows and clashing columns go through; an empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    lost = docs.limit(3)
    for name in ("text", "lang", "source", "n_chars", "doc_id"):
        lost = lost.unionByName(docs.limit(3).withColumn(name, F.lit(None).cast(docs.schema[name].dataType)))
    odd = docs.unionByName(docs.limit(5)).unionByName(lost)
    for name in ("__nth", "hash1", "row", "a.b", "_text", "_all", "fingerprint", "score", "tid"):
        odd = odd.withColumn(name, F.lit(name))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for name, frame in (("odd", odd), ("empty", odd.limit(0))):
        frame.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert out and len({(r.doc_id, r.piece) for r in out}) == len(out)  # no copy is left
    assert {r.doc_id for r in out} <= {r.doc_id for r in odd.collect()}
    empty = corpus_pipeline.run(spark, f"{tmp_path}/empty")
    assert empty.count() == 0 and "sequence_id" in empty.columns


def test_stage_tables_go(spark, sf_dir, monkeypatch, tmp_path):
    """At the end one stage's table is left, that of the last one read."""
    made = []

    def kept(df, label):
        made.append(store(df, label))
        return made[-1]

    monkeypatch.setattr(corpus_pipeline, "store", kept)
    corpus_pipeline.run(spark, sf_dir)
    there = [os.path.isdir(df._stored_at) for df in made]
    assert there == [False] * (len(made) - 1) + [True]
