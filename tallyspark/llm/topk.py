"""Exact top-k inner products, pruned by segment statistics from coarse to fine.

A vector is cut into segments; each keeps its mean and deviation (times the square root of its
length). By Cauchy-Schwarz the inner product of two vectors is at most the sum over segments of
``mean * mean + deviation * deviation``: the same statistics that bound a distance from below
bound the product from above. Levels of 1, 4 and 16 segments are tried in turn, and only
candidates whose bound reaches some query's k-th best score so far are computed exactly. A level
that spares next to nothing is tried less often, down to once in 64 times; that changes the time,
never the result.

Components are ``floor(256 * x)`` as integers, so scores are exact. Rows whose id or vector is
null, or whose vector holds a null or non-finite component, take no part. Vectors are compared
with vectors of the same length only. A query is never matched with rows of its own id; rows
that repeat an id and a vector count once. Ties go to the smaller id. Fewer than ``k``
candidates give all of them; empty tables give an empty result.

The queries are a stated set. Both sides are packed into blocks of at most ``BLOCK`` vectors,
which are written once. Query blocks are dealt into groups that a task can hold (``HELD`` bytes)
and candidate blocks into groups by the work to do; each pair of groups is a cell, and the blocks
of a cell meet in one task: the queries are held, the candidates stream past. How often a block is
sent follows the bytes and the work, not the number of shuffle partitions. No block passes the
driver, and no side is broadcast: a plan's size of the query blocks is that of their compressed
files, before they are dealt to the cells. What a task passes on is ``k`` rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import stage

LEVELS = (1, 4, 16)
BLOCK = 2048
SCALE = 256
#: Bytes of a block's integers, at most (one vector at least); bytes of the queries a task holds.
BLOCK_BYTES = 1 << 20
HELD = 128 << 20
#: Multiplications of a cell; the copies of the query blocks have a quarter of the bytes of the
#: candidates' copies, or ``COPIES`` bytes.
CELL_WORK = 1 << 35
COPIES = 256 << 20
_CHUNK = 512
#: Below these products of size and magnitudes, sums of integer products are exact.
_EXACT = {np.float32: 2.0**24, np.float64: 2.0**53}
_NONE, _TOO_LOW = np.iinfo(np.int64).min, np.iinfo(np.int64).min + 1
_STATISTICS = 2 * sum(LEVELS)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of the rows that take part, components as integers."""
    v = F.col(vector_col).cast("array<double>")
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    return kept.select("vec_id", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("long")).alias("vector"))


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same integers in the fewest bytes that hold them all."""
    low, high = vectors.min(initial=0), vectors.max(initial=0)
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return vectors.astype(kind)


class _Gathered:
    """Vectors of one length, taken in as they come and given out in blocks of ``size``."""

    def __init__(self, size: int):
        self.size, self.parts, self.count = size, [], 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.parts.append((ids, vectors))
        self.count += len(ids)
        if self.count >= self.size:
            ids, vectors = self.all()
            whole = len(ids) - len(ids) % self.size
            for at in range(0, whole, self.size):
                yield ids[at : at + self.size], vectors[at : at + self.size]
            if whole < len(ids):
                self.parts, self.count = [(ids[whole:].copy(), vectors[whole:].copy())], len(ids) - whole

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        ids, vectors = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.count = [], 0
        return ids, vectors


def pack(rows: DataFrame, size: int = BLOCK) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length. Of ``vec_id, vector, asked``, all rows are
    in blocks of candidates, and those asked in blocks of queries as well. ``number`` counts the
    blocks of a kind within a task, from the task's number on."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bool, int], _Gathered] = {}
        task = TaskContext.get().partitionId()
        numbers = {False: task, True: task}
        names = ["asked", "number", "dim", "width", "size", "ids", "vectors"]

        def block(asked: bool, ids: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
            small = _narrow(vectors)
            number = numbers[asked]
            numbers[asked] += 1
            row = [asked, number, vectors.shape[1], small.itemsize, len(ids), ids.tobytes(), small.tobytes()]
            types = [pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        for batch in batches:
            ids, lists, asked = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False)
            at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            lengths = np.diff(at)
            for dim in np.unique(lengths):
                of = np.flatnonzero(lengths == dim)
                vectors = values[at[of][:, None] + np.arange(dim)]
                for kind, some in ((False, slice(None)), (True, asked[of])):
                    most = max(1, min(size, BLOCK_BYTES // (8 * max(1, int(dim)))))
                    got = held.setdefault((kind, int(dim)), _Gathered(most))
                    for full in got.add(ids[of][some], vectors[some]):
                        yield block(kind, *full)
        for (kind, _), got in sorted(held.items()):
            if got.count:
                yield block(kind, *got.all())

    return rows.mapInArrow(blocks, "asked boolean, number long, dim int, width int, size int, ids binary, vectors binary")


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means then deviations per segment, each times the root of the segment's length."""
    n, dim = vectors.shape
    cuts = np.unique(np.linspace(0, dim, min(segments, max(1, dim)) + 1).astype(int))
    starts, lengths = cuts[:-1], np.diff(cuts)
    if not len(starts):
        return np.zeros((n, 1))
    sums = np.add.reduceat(vectors, starts, axis=1)
    squares = np.add.reduceat(vectors * vectors, starts, axis=1)
    deviations = np.sqrt(np.maximum(squares - sums * sums / lengths, 0))
    return np.hstack([sums / np.sqrt(lengths), deviations])


class _Side:
    """Vectors of one length with what a search needs of them, as floats of a width that is asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        pieces = [vectors[at : at + BLOCK].astype(float) for at in range(0, len(ids), BLOCK)]
        self.norms = np.concatenate([np.sqrt((x * x).sum(axis=1)) for x in pieces])
        self.most = max(np.abs(x).max(initial=0) for x in pieces)
        self._forms: dict[type, tuple] = {}

    def form(self, kind: type) -> tuple[np.ndarray, list[np.ndarray]]:
        """Vectors and the statistics of each level."""
        if kind not in self._forms:
            stats = [[] for _ in LEVELS]
            for at in range(0, len(self.ids), BLOCK):
                floats = self.vectors[at : at + BLOCK].astype(float)
                for got, segments in zip(stats, LEVELS, strict=True):
                    got.append(segment_statistics(floats, segments).astype(kind))
            self._forms[kind] = self.vectors.astype(kind), [np.concatenate(x) for x in stats]
        return self._forms[kind]


class BlockSearch:
    """Running best ``k`` of a group of queries over any number of candidate blocks. An id that has
    several vectors counts once, by its best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.side, self.k = _Side(ids, vectors), k
        self.ids = np.zeros((len(ids), k), np.int64)
        self.scores = np.full((len(ids), k), _NONE)
        self.pause, self.wait = [0] * len(LEVELS), [0] * len(LEVELS)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        block = _Side(ids[order], vectors[order])
        firsts = np.flatnonzero(np.append(True, block.ids[1:] != block.ids[:-1]))
        product = block.most * self.side.most * max(1, vectors.shape[1])
        kind = np.float32 if product < _EXACT[np.float32] else np.float64
        for at in range(0, len(self.side.ids), _CHUNK):
            self._chunk(slice(at, min(at + _CHUNK, len(self.side.ids))), block, firsts, kind, product < _EXACT[np.float64])

    def _chunk(self, rows: slice, block: _Side, firsts: np.ndarray, kind: type, exact: bool) -> None:
        (mine, my_stats), (theirs, their_stats) = self.side.form(kind), block.form(kind)
        mine = mine[rows]
        last = self.scores[rows, -1]
        floor = np.where(last == _NONE, -np.inf, last.astype(float))
        norms = self.side.norms[rows] * block.norms.max()
        alive = None  # candidates that some query of the chunk may still want; None for all
        if (last != _NONE).all():
            # rounding can only loosen a bound
            low = (floor - 1e-5 * norms - 1e-6).astype(kind)[:, None]
            keep = None
            for i, (a, b) in enumerate(zip(my_stats, their_stats, strict=True)):
                if self.wait[i]:
                    self.wait[i] -= 1
                    continue
                keep = a[rows] @ (b if alive is None else b[alive]).T >= low
                some = np.flatnonzero(keep.any(axis=0))
                few = np.count_nonzero(keep) * 32 < keep.size
                self.wait[i] = self.pause[i] = 0 if few or len(some) < 0.9 * keep.shape[1] else min(2 * self.pause[i] + 1, 63)
                if not len(some):
                    return
                if len(some) < keep.shape[1]:
                    alive, keep = some if alive is None else alive[some], keep[:, some]
            if keep is not None and np.count_nonzero(keep) * 32 < keep.size:
                q, c = np.nonzero(keep)
                self._score(rows.start + q, c if alive is None else alive[c], block, None)
                return
        scores = mine @ (theirs if alive is None else theirs[alive]).T
        # products that are not exact are off by less than the slack, and settled below
        slack = np.zeros(len(mine)) if exact else norms * ((mine.shape[1] + 8) * 2.0**-52)
        new = np.flatnonzero(last == _NONE)
        if len(new) and len(firsts) >= self.k:  # then alive is None
            own = self.side.ids[rows][new][:, None] == block.ids[None, :]
            best = np.where(own, -np.inf, scores[new])
            best = np.maximum.reduceat(best, firsts, axis=1) if len(firsts) < best.shape[1] else best
            floor[new] = np.partition(best, -self.k, axis=1)[:, -self.k] - slack[new]
        low = np.nextafter((floor - slack).astype(kind), kind(-np.inf))
        some = np.flatnonzero(scores.max(axis=1) >= low)
        scores = scores[some]
        hits = np.flatnonzero((scores >= low[some, None]).ravel())
        q, c = np.divmod(hits, scores.shape[1])
        exactly = scores.ravel()[hits].astype(np.int64) if exact else None
        self._score(rows.start + some[q], c if alive is None else alive[c], block, exactly)

    def _score(self, q: np.ndarray, c: np.ndarray, block: _Side, scores: np.ndarray | None) -> None:
        """Take in pairs of a query and a candidate that may be among the query's best."""
        other = self.side.ids[q] != block.ids[c]
        q, c = q[other], c[other]
        scores = self._products(q, c, block) if scores is None else scores[other]
        last = self.scores[q, -1]
        better = (scores > last) | ((scores == last) & (block.ids[c] < self.ids[q, -1]))
        if better.any():
            self._merge(q[better], block.ids[c[better]], scores[better])

    def _products(self, q: np.ndarray, c: np.ndarray, block: _Side) -> np.ndarray:
        out = np.empty(len(q), np.int64)
        exact = block.most * self.side.most * max(1, block.vectors.shape[1]) < _EXACT[np.float64]
        for at in range(0, len(q), BLOCK):
            part = slice(at, at + BLOCK)
            a, b = self.side.vectors[q[part]], block.vectors[c[part]]
            if exact:
                out[part] = np.einsum("ij,ij->i", a.astype(np.int64), b.astype(np.int64))
                continue
            found = (a.astype(object) * b.astype(object)).sum(axis=1) if a.shape[1] else np.zeros(len(a), object)
            if max(found) > np.iinfo(np.int64).max:
                raise OverflowError("a score is beyond a long")
            out[part] = np.maximum(found, _TOO_LOW).astype(np.int64)
        return out

    def _merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        rows = np.unique(q)
        held = self.scores[rows] != _NONE
        q = np.concatenate((np.repeat(rows, held.sum(axis=1)), q))
        ids, scores = np.concatenate((self.ids[rows][held], ids)), np.concatenate((self.scores[rows][held], scores))
        q, ids, scores, rank = _ranked(q, ids, scores, self.k)
        self.scores[rows] = _NONE
        self.ids[q, rank], self.scores[q, rank] = ids, scores

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, ids and scores: the best of each query id."""
        if (self.scores == _TOO_LOW).any():
            raise OverflowError("a score is beyond a long")
        held = self.scores != _NONE
        return _ranked(np.repeat(self.side.ids, held.sum(axis=1)), self.ids[held], self.scores[held], self.k)[:3]


def _ranked(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best of each ``q``, an id counted once, in order, with their ranks from 0."""
    order = np.lexsort((~scores, ids, q))
    q, ids, scores = q[order], ids[order], scores[order]
    once = np.ones(len(q), bool)
    once[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, scores = q[once], ids[once], scores[once]
    order = np.lexsort((ids, ~scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, len(q)), bool), q[1:] != q[:-1])))
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    top = rank < k
    return q[top], ids[top], scores[top], rank[top]


def grid(blocks: DataFrame) -> tuple[int, int]:
    """Numbers of query groups and of candidate groups for the blocks (one row comes to the driver)."""
    asked, size = F.col("asked"), F.col("size").cast("double")
    each = blocks.groupBy("dim").agg(
        *(F.coalesce(F.sum(F.when(when, size)), F.lit(0.0)).alias(name) for name, when in (("q", asked), ("c", ~asked))),
        *(F.coalesce(F.sum(F.when(when, size * F.col("dim") * F.col("width"))), F.lit(0.0)).alias(name) for name, when in (("qb", asked), ("cb", ~asked))),
        *(F.count(F.when(when, 1)).alias(name) for name, when in (("qn", asked), ("cn", ~asked))),
    )
    wide = F.col("dim") + _STATISTICS
    got = each.agg(F.sum(F.col("q") * wide * 8), F.sum(F.col("q") * F.col("c") * wide), *(F.sum(x) for x in ("qb", "cb", "qn", "cn"))).first()
    held, work, q_bytes, c_bytes, q_blocks, c_blocks = (float(x or 0) for x in got)
    groups = max(1, min(int(q_blocks), math.ceil(held / HELD)))
    copies = max(groups * c_bytes / 4, COPIES) / max(1.0, q_bytes)
    return groups, max(1, min(int(c_blocks), int(copies), math.ceil(work / CELL_WORK / groups)))


def top_k(
    rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best rows.

    ``is_query`` is a condition on ``vec_id``. Scores beyond a long raise an error.
    """
    vectors = integer_vectors(rows, id_col, vector_col).distinct().withColumn("asked", F.coalesce(is_query, F.lit(False)))
    # a block's rows, bytes and number follow the order of arrival, so blocks are written once: a
    # repeated task of the search must meet the same blocks in the same cells
    blocks, _ = stage(pack(vectors, block), "blocks")
    q_groups, c_groups = grid(blocks)

    def upto(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    own_q, own_c = F.pmod("number", F.lit(q_groups)), F.pmod("number", F.lit(c_groups))
    cells = F.when(F.col("asked"), F.transform(upto(c_groups), lambda c: own_q * c_groups + c)).otherwise(
        F.transform(upto(q_groups), lambda q: q * c_groups + own_c)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell: int | None = None
        asked: dict[int, list] = {}
        searches: dict[int, BlockSearch] = {}
        waiting: dict[int, _Gathered] = {}

        def done() -> Iterator[pa.RecordBatch]:
            for dim, got in waiting.items():
                if got.count:
                    searches[dim].add(*got.all())
            for one in searches.values():
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in one.found()], ["query_id", "vec_id", "score"])

        for batch in batches:
            for i in range(batch.num_rows):
                at, is_asked, dim, width, ids, found = (batch.column(c)[i].as_py() for c in range(6))
                if at != cell:
                    yield from done()
                    cell, asked, searches, waiting = at, {}, {}, {}
                ids = np.frombuffer(ids, np.int64)
                found = np.frombuffer(found, f"i{width}").reshape(len(ids), dim)
                if is_asked:  # a cell's queries come before its candidates
                    asked.setdefault(dim, []).append((ids, found))
                    continue
                if dim in asked:
                    searches[dim] = BlockSearch(*(np.concatenate(x) for x in zip(*asked.pop(dim), strict=True)), k)
                    waiting[dim] = _Gathered(min(block, max(1, BLOCK_BYTES // max(1, dim))))
                if dim in searches:
                    for full in waiting[dim].add(ids, found):
                        searches[dim].add(*full)
        yield from done()

    dealt = blocks.withColumn("cell", F.explode(cells)).select("cell", "asked", "dim", "width", "ids", "vectors")
    dealt = dealt.repartitionById(q_groups * c_groups, F.col("cell").cast("int")).sortWithinPartitions("cell", F.col("asked").desc())
    found = dealt.mapInArrow(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")  # k rows per query and cell
    once = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranks = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
