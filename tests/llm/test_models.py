"""Held-out accuracy of the two classifiers, and the pipeline, on small tables."""

import os

import pytest
from pyspark.sql import functions as F

from linkmill.llm.queries import queries

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the shared tables")


def held_out(spark, query, label):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    return queries()[query](spark, DATA).where("held_out").join(labels, "doc_id").select("score", "predicted", "y").collect()


def ranking(rows):
    pos, neg = [r.score for r in rows if r.y == 1], [r.score for r in rows if r.y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_toxicity_held_out(spark):
    rows = held_out(spark, "op1_toxicity", "toxic")
    assert ranking(rows) > 0.75
    assert sum(r.predicted for r in rows if r.y == 0) <= 0.05 * sum(r.y == 0 for r in rows)


def test_quality_held_out(spark):
    rows = held_out(spark, "op5_quality", "quality")
    assert ranking(rows) > 0.97
    assert sum(r.predicted for r in rows if r.y == 1) >= 0.98 * sum(r.y == 1 for r in rows)


def test_pipeline_stages(spark, tmp_path, nasty):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before = docs.count()
    for k, (name, stage) in enumerate(c.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert docs.columns == c.COLUMNS
            assert docs.count() <= before
            before = docs.count()
            assert docs.groupBy("doc_id").count().where("count > 1").count() == 0
        if name == "near_duplicates":
            assert queries()  # the stage keeps one of each group:
            from linkmill.llm.jaccard_join import jaccard_components

            assert jaccard_components(docs, c.WIDTH, c.PERCENT).where("doc_id <> component_id").count() == 0
        if name == "decontamination":
            from linkmill.llm.decontaminate import contamination

            assert contamination(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).where(F.size("spans") > 0).count() == 0
        if name == "secrets":
            from linkmill.llm.secret_scan import secret_scan

            assert secret_scan(docs).where(F.size("base") > 0).count() == 0


def test_pipeline_stages_on_edges(spark, nasty, empty):
    import corpus_pipeline as c

    for docs in (nasty, empty):
        for _, stage in c.STAGES:
            stage(spark, docs, DATA).collect()
    kept = [r.doc_id for r in c.near_duplicates(spark, nasty, DATA).collect()]
    assert kept.count(5) == 1 and 6 not in kept and kept.count(None) == 2 and 0 in kept


def test_near_duplicates_of_repeated_ids(spark):
    import corpus_pipeline as c

    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in "abcd"]
    data = [(1, texts[0]), (5, texts[0]), (5, texts[1]), (5, texts[2]), (5, texts[2]), (7, texts[1]), (8, texts[3]), (8, None), (None, texts[3])]
    docs = spark.createDataFrame([(i, t, "en", "s", 9) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(((r.doc_id, r.text) for r in c.near_duplicates(spark, docs, DATA).collect()), key=str)
    assert kept == sorted([(1, texts[0]), (5, texts[1]), (5, texts[2]), (8, texts[3]), (8, None), (None, texts[3])], key=str)
