"""Quality grading: ordinal cumulative-link regression on hashed text.

Grades are 0 (toxic), 1 (low quality) and 2 (good). One weight vector over hashed features is
shared by all grades and ordered thresholds cut the score: ``P(grade <= k) =
sigmoid(threshold_k - score)``. The expected grade and the tail probability ``P(grade >= 2)``
follow; a document is kept when its tail probability reaches ``keep_at``.

Features of the whole text: presence of each distinct hashed word (runs of letters and digits,
scaled by the square root of their number), frequencies of hashed byte trigrams, the share of
words that repeat the word before, the share of distinct words and the mean word length. They
are computed with numpy over Arrow batches.

The model is fitted on at most ``sample_per_grade`` labelled documents of each grade, chosen by
a seeded hash of the id; grading covers every document. Null text counts as empty and is
graded like any other; labels that are null or name no document are ignored; several labels of
one document count once (its lowest grade). Without any label nothing is rejected and all
figures are null. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import words
from tallyspark.llm.common import fresh_name, small_batches

BITS = 18
GRADES = 3
SAMPLE_PER_GRADE = 2000
KEEP_AT = 0.5
SEED = 7
_SHIFT = np.uint64(64 - BITS)
_TRIGRAM_SCALE = 8.0
_DENSE = 2 << BITS  # the four dense features come after words and trigrams


@dataclass
class Model:
    """Shared weights and ordered thresholds."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score):
        """``P(grade >= k)`` for k = 1, 2, ... in columns."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -60, 60)))


def _parts(text: str | None):
    """Distinct word buckets, trigram buckets (one per place) and the dense features."""
    found = words.text_words(text, words.ALNUM)
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = (data[:-2] << 16 | data[1:-1] << 8 | data[2:]) if len(data) > 2 else np.empty(0, np.uint32)
    trigrams = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    distinct = np.unique((found >> _SHIFT).astype(np.int32))
    n = max(1, len(found))
    repeats = float(np.mean(found[1:] == found[:-1])) if len(found) > 1 else 0.0
    dense = np.array([1.0, min(1.0, 5 * repeats), len(distinct) / n, min(2.0, len(data) / n / 20)])
    return distinct, trigrams.astype(np.int32), dense


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sparse features of one whole text: indices and values."""
    distinct, trigrams, dense = _parts(text)
    kinds, counts = np.unique(trigrams, return_counts=True)
    index = np.concatenate((distinct, kinds + (1 << BITS), _DENSE + np.arange(4))).astype(np.int32)
    value = np.concatenate(
        (np.full(len(distinct), max(1, len(distinct)) ** -0.5), counts * (_TRIGRAM_SCALE / max(1, len(trigrams))), dense)
    )
    return index, value


def score(text: str | None, weights: np.ndarray) -> float:
    """``features(text)`` times ``weights``."""
    distinct, trigrams, dense = _parts(text)
    total = weights[distinct].sum() * max(1, len(distinct)) ** -0.5 + dense @ weights[_DENSE:]
    return float(total + weights[(1 << BITS) :][trigrams].sum() * (_TRIGRAM_SCALE / max(1, len(trigrams))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Maximum likelihood by AdaGrad over batches of 64; rare grades weigh more. Small samples
    are gone through more often, for about the same number of steps."""
    epochs = int(np.clip(120_000 // max(1, len(rows)), 10, 200))
    weights, thresholds = np.zeros(_DENSE + 4), np.array([-2.0, -1.0])
    seen, seen_t = np.full(len(weights), 1e-2), np.full(GRADES - 1, 1e-2)
    count = np.bincount(grades, minlength=GRADES)
    importance = np.sqrt(len(grades) / GRADES / np.maximum(1, count))
    lengths = np.array([len(i) for i, _ in rows])
    rng = np.random.default_rng(SEED)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), 64):
            batch = order[at : at + 64]
            index = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            row = np.repeat(np.arange(len(batch)), lengths[batch])
            grade = grades[batch]
            eta = np.bincount(row, weights[index] * value, len(batch))
            cuts = np.concatenate(([-60.0], thresholds, [60.0]))
            upper, lower = sigmoid(cuts[grade + 1] - eta), sigmoid(cuts[grade] - eta)
            scale = importance[grade] / np.maximum(upper - lower, 1e-9) / len(batch)
            d_upper, d_lower = upper * (1 - upper) * scale, lower * (1 - lower) * scale
            used, place = np.unique(index, return_inverse=True)
            slope = np.bincount(place, (d_upper - d_lower)[row] * value, len(used)) + decay * weights[used]
            seen[used] += slope**2
            weights[used] -= rate * slope / np.sqrt(seen[used])
            slope = np.array([d_lower[grade == k + 1].sum() - d_upper[grade == k].sum() for k in range(GRADES - 1)])
            seen_t += slope**2
            thresholds = np.sort(thresholds - rate * slope / np.sqrt(seen_t))
    return Model(weights, thresholds)


def graded_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` from quality and toxic flags."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where("grade is not null and doc_id is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def sample_features(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, per_grade: int = SAMPLE_PER_GRADE):
    """Features and grades of at most ``per_grade`` documents of each grade, in id order."""
    by_hash = [F.xxhash64(F.lit(SEED), "doc_id"), F.col("doc_id")]
    known = docs.select(F.col(id_col).alias("doc_id")).where("doc_id is not null").distinct()
    pool = grades.join(known, "doc_id", "left_semi")
    chosen = pool.where("grade = 0").orderBy(*by_hash).limit(per_grade)
    for g in range(1, GRADES):
        chosen = chosen.unionByName(pool.where(F.col("grade") == g).orderBy(*by_hash).limit(per_grade))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            got = [features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([i.tobytes() for i, _ in got], pa.binary()),
                    pa.array([v.astype(np.float32).tobytes() for _, v in got], pa.binary()),
                ],
                ["doc_id", "grade", "at", "value"],
            )

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # at most GRADES * per_grade ids: bounded, so the texts are filtered where they are read
    picked = F.broadcast(chosen).join(texts, "doc_id").select("doc_id", "grade", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    rows = picked.mapInArrow(extract, f"doc_id {kind}, grade int, at binary, value binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.grade, bytes(r.at), bytes(r.value)))
    sparse = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r["value"], np.float32).astype(float)) for r in rows]
    return sparse, np.array([r.grade for r in rows], np.int64)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_grade: int = SAMPLE_PER_GRADE) -> Model | None:
    """The model, or None when no document has a label."""
    rows, grades = sample_features(docs, graded_labels(labels), id_col, text_col, per_grade)
    return fit(rows, grades) if rows else None


def grade(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """One row per document: ``doc_id, expected_grade, tail_probability, keep``."""
    ids = F.col(id_col).alias("doc_id")
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(ids, none.alias("expected_grade"), none.alias("tail_probability"), F.lit(True).alias("keep"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def assess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in small_batches(batches):
            tails = fitted.tails([score(t, fitted.weights) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= keep_at)],
                ["doc_id", "expected_grade", "tail_probability", "keep"],
            )

    fields = [
        T.StructField("doc_id", docs.schema[id_col].dataType),
        T.StructField("expected_grade", T.DoubleType()),
        T.StructField("tail_probability", T.DoubleType()),
        T.StructField("keep", T.BooleanType()),
    ]
    return docs.select(ids, F.col(text_col).alias("text")).mapInArrow(assess, T.StructType(fields))


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that are kept, with all their columns."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = fresh_name(docs.columns, "__text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in small_batches(batches):
            tails = fitted.tails([score(t, fitted.weights) for t in batch.column(batch.num_columns - 1).to_pylist()])
            kept = batch.filter(pa.array(tails[:, -1] >= keep_at))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

    return docs.withColumn(text, F.col(text_col)).mapInArrow(choose, docs.schema)
