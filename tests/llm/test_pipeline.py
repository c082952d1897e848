"""The pipeline's stages on a small table, each held to what its decisions must be."""

import os

import pytest

import corpus_pipeline
from tests.llm.test_repeats import components_by_hand
from tidemark.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        rows[name] = docs.count()
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.severities(before, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("toxic").collect()}
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - bad
        elif name == "n-gram Jaccard join":
            pairs = [(r.doc_id, r.text) for r in before.collect()]
            want = sorted(d for d, _, c in components_by_hand(pairs, 5, 80) if d == c)
            assert sorted(r.doc_id for r in docs.collect()) == want
        elif name == "mixing sources to target weights":
            want = sum(r.taken for r in mixing.take(before).collect())
            assert sum(len((r.text or "").encode().split()) for r in docs.collect()) == want
        if name != "packing":
            assert docs.columns == columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(rows) and all(rows.values())
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(docs.columns)


def test_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert docs.collect() == []
