"""The corpus pipeline over the smallest tables: each stage against brute force on its own input."""

import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are missing")


def test_stages(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from tests.llm.test_llm import brute_components, brute_substrings
    from trackweave.llm import quality_rules, store

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near-duplicates", "substring dedup", "decontamination", "mixing"]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = store.materialise(stage(spark, docs, SF), "test-stage")
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append((name, before, docs))
    rows = lambda d: [(r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()]
    _, before, after = kept[0]
    good = {r["doc_id"] for r in quality_rules.verdicts(before, ["doc_id"]).where("kept").collect()}
    assert {i for i, _ in rows(after)} == good
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert before.join(labels.where("quality = 1"), "doc_id").join(after, "doc_id", "left_anti").where(F.size(F.split("text", r"\s+")) >= 60).count() == 0
    _, before, after = kept[1]
    want = {i for i, (_, c) in brute_components(rows(before), 80).items() if i == c}
    assert {i for i, _ in rows(after)} == want
    _, before, after = kept[2]
    brute = brute_substrings(rows(before), 20)
    assert {i for i, _ in rows(after)} == {i for i, [(n, gone, _)] in brute.items() if gone < n or not n}
    _, before, after = kept[3]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    flat = lambda t: " ".join(t.split())
    assert {i for i, _ in rows(before)} - {i for i, _ in rows(after)} == {i for i, t in rows(before) if any(flat(b) in flat(t) for b in bench)}
    mixed = kept[4][2].groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert mixed and all(abs(r["taken"] - r["target"]) <= r["most"] for r in mixed)
    assert kept[4][2].where("taken > 2 * size OR taken <= 0").count() == 0
