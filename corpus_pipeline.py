"""A training corpus from raw documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet
and reread as the next stage's documents, so a lost executor costs no more than one stage's
tasks. All stages but the last return the columns of ``documents``.

1. quality classifier: documents whose probability of the top grade is too low go;
2. exact dedup: of equal texts, the document with the smallest id stays;
3. n-gram Jaccard join: of each group of near copies, the one with the smallest id stays;
4. mixing: sources are repeated or thinned to their target weights;
5. SentencePiece: the ids of every document, as digests with the decoded text's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import exact_dedup, grading, jaccard, mixing, pieces
from tallyspark.llm.common import read, stage

#: The classifier's weights and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return grading.keep_good(docs, grading.train(docs, read(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.drop_near_copies(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.token_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each on the written result of the one before."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs, _ = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
