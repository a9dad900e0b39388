"""Centroid clustering sharded by dimension: exact integer Lloyd rounds.

Vectors are packed into row blocks and each row block is cut into column blocks (shards), written
once. In a round every column block meets only its slice of the centroids and gives exact
partial squared distances; these are added per row block and the smallest total wins. Then
every shard sums its own columns by cluster and computes its own slice of the new centroids, so
no task needs whole vectors or whole centroids, and what is shuffled is one number per vector,
centroid and shard held by a task.

Components become ``floor(scale * x)``; all sums are of integers, so results do not depend on
partitioning. Vectors that are null, of another dimension, or hold null or non-finite components
take no part. Repeated rows all count. Ties between centroids go to the smaller number. The
centroids start as the ``k`` vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` (a null id is
written as nothing; vectors that share an id follow their components); with fewer vectors there are
fewer centroids, with none the result is empty. A scaled component of ``2**27`` or more, whose
squared distances could exceed a long, is an error. Extra columns are not read.

What the driver holds is the centroids (``k`` times the dimension), never a vector per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import stage

SCALE = 64
DIM = 64
K = 16
ROUNDS = 3
SEED = 1
#: Columns of a shard and vectors of a row block: a column block holds 128 KB.
SHARD = 16
ROWS = 1024
LARGEST = 2**27


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, components as integers."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = rows.select(F.col(id_col).alias("vec_id"), v.alias("v")).where((F.size("v") == dim) & F.coalesce(finite, F.lit(False)))

    def whole(x):
        scaled = F.floor(x * F.lit(float(scale)))
        too_large = F.raise_error(F.lit(f"a component is {LARGEST} or more after scaling: distances may exceed a long"))
        return F.when(F.abs(x * F.lit(float(scale))) < LARGEST, scaled).otherwise(too_large.cast("long"))

    return kept.select("vec_id", F.transform("v", whole).alias("vector"))


def pack(vectors: DataFrame, dim: int, shard: int = SHARD, rows: int = ROWS) -> DataFrame:
    """Column blocks ``block, shard, ids, data``: row blocks of at most ``rows`` vectors of one
    task, cut into ``shard`` columns each; the ids lie with the first shard."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    cuts = range(0, dim, shard)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                whole = part.column(1).flatten().to_numpy().reshape(part.num_rows, dim)
                ids = [part.column(0)] + [None] * (len(cuts) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(cuts), pa.int64()),
                        pa.array(range(len(cuts)), pa.int32()),
                        pa.array([i and i.to_pylist() for i in ids], pa.list_(part.column(0).type)),
                        pa.array([whole[:, c : c + shard].astype(np.int64).tobytes() for c in cuts], pa.binary()),
                    ],
                    names=["block", "shard", "ids", "data"],
                )
                number += 1

    return vectors.mapInArrow(blocks, f"block long, shard int, ids array<{kind}>, data binary")


def partial_distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of every vector to every centroid over the columns of one shard."""
    out = np.empty((len(block), len(centroids)), np.int64)
    for c, centre in enumerate(centroids):
        gap = block - centre
        out[:, c] = (gap * gap).sum(axis=1)
    return out


def _shards(batches: Iterator[pa.RecordBatch], width: dict[int, int], *columns: str):
    """(shard, matrix, other columns) of every column block."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("shard", "data", *columns)}
            yield row["shard"], np.frombuffer(row["data"], np.int64).reshape(-1, width[row["shard"]]), *(row[c] for c in columns)


def assign(packed: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """``block, labels, distances``: per row block the nearest centroid of each vector and its
    squared distance. Column blocks that a task holds are added there, the rest after a shuffle."""
    k, width = len(slices[0]), {s: part.shape[1] for s, part in enumerate(slices)}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for shard, data, block in _shards(batches, width, "block"):
            part = partial_distances(data, slices[shard])
            if block == held:
                total += part
                continue
            if held is not None:
                yield one(held, total)
            held, total = block, part
        if held is not None:
            yield one(held, total)

    def one(block: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})

    def nearest(key: tuple, parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p, np.int64) for p in parts.column("total").to_pylist()).reshape(-1, k)
        labels = total.argmin(axis=1)  # the first of equal ones
        least = total[np.arange(len(total)), labels]
        return pa.table({"block": [key[0].as_py()], "labels": [labels.tolist()], "distances": [least.tolist()]}, schema=out)

    out = pa.schema([("block", pa.int64()), ("labels", pa.list_(pa.int32())), ("distances", pa.list_(pa.int64()))])
    parts = packed.select("block", "shard", "data").mapInArrow(measure, "block long, total binary")
    return parts.groupBy("block").applyInArrow(nearest, "block long, labels array<int>, distances array<long>")


def update(packed: DataFrame, labels: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """New slices: every shard sums its own columns by cluster, per task first, and takes the
    floor of each mean; empty clusters keep theirs."""
    k, width = len(slices[0]), {s: part.shape[1] for s, part in enumerate(slices)}
    schema = pa.schema([(c, pa.int64()) for c in ("shard", "cluster", "column", "total", "members")])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        members: dict[int, np.ndarray] = {}
        for shard, data, own in _shards(batches, width, "labels"):
            np.add.at(sums.setdefault(shard, np.zeros((k, width[shard]), np.int64)), own, data)
            members[shard] = members.get(shard, 0) + np.bincount(own, minlength=k)
        for shard, total in sums.items():
            cluster, column = (at.ravel() for at in np.indices(total.shape))
            some = members[shard][cluster] > 0
            found = (np.full(total.size, shard), cluster, column, total.ravel(), members[shard][cluster])
            yield pa.RecordBatch.from_arrays([pa.array(c[some], pa.int64()) for c in found], schema=schema)

    joined = packed.select("block", "shard", "data").join(labels.select("block", "labels"), "block")
    sums = joined.select("shard", "data", "labels").mapInArrow(add, ", ".join(f"{c} long" for c in schema.names))
    means = sums.groupBy("shard", "cluster", "column").agg(F.sum("total").alias("s"), F.sum("members").alias("n"))
    new = [part.copy() for part in slices]
    for shard, c, column, mean in means.select("shard", "cluster", "column", F.expr("(s - pmod(s, n)) div n")).collect():
        new[shard][c, column] = mean  # at most k x dim numbers
    return new


def cluster(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    seed: int = SEED,
    shard: int = SHARD,
) -> DataFrame:
    """One row per vector: ``vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256``."""
    spark = rows.sparkSession
    vectors = integer_vectors(rows, id_col, vector_col, dim, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.orderBy(order, "vector").limit(k).collect()  # k vectors
    packed, _ = stage(pack(vectors, dim, shard), "column-blocks")
    centroids = np.array([r["vector"] for r in first], np.int64).reshape(len(first), dim)
    slices = [centroids[:, c : c + shard] for c in range(0, dim, shard)]
    if len(first):
        for _ in range(rounds):
            slices = update(packed, assign(packed, slices), slices)
    kind = vectors.schema["vec_id"].dataType
    ids = packed.where("shard = 0").select("block", "ids")
    nearest = assign(packed, slices).join(ids, "block")
    rows_of = nearest.select(F.explode(F.arrays_zip("ids", "labels", "distances")).alias("v"))
    found, _ = stage(
        rows_of.select(F.col("v.ids").cast(kind).alias("vec_id"), F.col("v.labels").alias("cluster"), F.col("v.distances").alias("distance")),
        "clusters",
    )
    final = np.hstack(slices)
    digests = [(i, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(final)]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    per_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # k rows
    total = found.agg(F.sum("distance").alias("inertia"))
    figures = per_cluster.join(F.broadcast(names), "cluster").withColumn("inertia", total.scalar())
    return found.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
