"""The pipeline: every stage takes effect and keeps the columns of documents."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from closure_engine.llm.common import release
from closure_engine.llm.jaccard import jaccard_groups
from closure_engine.llm.quality import quality_rules

NAMES = ["quality rules", "near copies", "secret scans", "mixing", "packing"]


@pytest.fixture(scope="module")
def steps(spark, sf, tmp_path_factory):
    docs = [spark.read.parquet(f"{sf}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs[-1], sf).write.parquet(path)
        docs.append(spark.read.parquet(path))
    return docs


def test_stages(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for d in steps[:-1]:
        assert d.dtypes == steps[0].dtypes


def test_quality_and_copies(steps):
    kept = {r["doc_id"] for r in quality_rules(steps[0]).collect() if r["kept"]}
    assert {r["doc_id"] for r in steps[1].collect()} == kept
    groups = {r["component_id"] for r in jaccard_groups(steps[1]).collect()}
    assert Counter(r["doc_id"] for r in steps[2].collect()) == Counter(groups)


def test_secrets_and_mixing(steps):
    before, after = ({r["doc_id"]: r for r in d.collect()} for d in steps[2:4])
    assert set(before) == set(after)
    changed = [i for i in before if before[i]["text"] != after[i]["text"]]
    assert changed and all("<" in after[i]["text"] for i in changed)
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    mixed = Counter(r["doc_id"] for r in steps[4].collect())
    assert max(mixed.values()) <= 3 and set(mixed) < set(after)
    assert all(r["text"] == after[r["doc_id"]]["text"] for r in steps[4].collect())


def test_packing(steps):
    lengths = steps[5].groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r["n"] <= 2048 and r["n"] & (r["n"] - 1) == 0 for r in lengths)
    assert {r["doc_id"] for r in steps[5].select("doc_id").distinct().collect()} == {r["doc_id"] for r in steps[4].collect()}


def test_awkward_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert {r["doc_id"] for r in docs.select("doc_id").distinct().collect()} <= {6, 7, 10, 13, 16, None}


def test_registered(spark, sf):
    queries = __spark_entry__.queries()
    assert "pipeline" in queries and {int(q[2:].split("_")[0]) for q in queries if q.startswith("op")} == set(range(1, 11))
    assert corpus_pipeline.run(spark, sf).count() > 0
    assert release(spark) > 0
