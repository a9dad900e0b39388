"""The pipeline stage by stage against plain Python, and every registered query on sf0.001."""

import re

import corpus_pipeline
from pyspark.sql import functions as F

from tallyspark.llm import exact_dedup, grading, jaccard, mixing, pieces, queries
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = grading.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in grading.grade(docs, model).collect() if r.keep}
    good = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in kept]
    first = {}
    for i, t in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), (i, t))
    unique = sorted(first.values())
    alone = {i for i, _, c in brute_components(unique) if i == c}
    left = docs.where(F.col("doc_id").isin(sorted(alone)))
    mixed = mixing.mixed_documents(left)
    expected = sorted(map(tuple, pieces.token_digests(mixed).collect()))
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == expected and got


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert exact_dedup and jaccard
