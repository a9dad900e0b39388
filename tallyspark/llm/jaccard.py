"""Exact Jaccard join of word shingle sets, size-aware, down to connected components.

A document's set holds the distinct hashes of its five-word shingles. Two documents link when
``100 * |A & B| >= 80 * |A | B|``; components are the connected documents. Equal sets are one
*class* from the start, so copies of a text are never paired with each other.

Size-aware split (light and heavy sets)
    Two sets of n and m elements link exactly when they share ``c(n, m) = ceil(80 (n + m) /
    180)`` elements. Small sets therefore enumerate their subsets of each such size: small sets
    that meet in a subset are linked, without any further check, and one star per subset from
    its smallest member keeps all that is connected by it connected. Large sets are found
    through inverted lists instead: of each set, the ``n - ceil(0.8 n) + 1`` rarest elements
    are listed, because two linked sets share one of those. The boundary between small and
    large is chosen by cost, from the corpus's histogram of set sizes: subsets to enumerate
    against list entries to write and pairs they lead to.
Order of elements
    Rarest first, by counts of the elements that are frequent in some stretch of rows (at most
    ``FREQUENT``, broadcast), then by hash. Any order is right; a passage that many documents
    share moves to the end of it and lists nothing.
Lists
    Lists of up to ``SHORT_LIST`` members propose all their pairs. Longer ones (families of near
    copies) are cut into blocks of about ``LIST_BLOCK`` members by a hash of the member and first
    propose each member with its nearest member and with the block's medoid, by the distance of
    parity bitmaps (in two random blocks when there are several); after the components of those are known, every remaining pair of members of
    *different* components is proposed: the members outside the list's largest component meet all
    members, block against block. A pair within one component would not change it, so nothing is
    lost, and a family of g texts gives neither g * g pairs nor g * g comparisons.
Verification
    A proposed pair must pass a parity bitmap filter (the number of differing bits is at most
    the symmetric difference) and is then verified exactly on the two whole sets.
Components
    Smallest labels spread along verified links (written out in each round), with every
    component's label jumping to the label's own label, until nothing changes.

Null texts and texts without words have no shingles and link with nothing; a document's
``component_id`` is then its own doc_id. Rows that repeat a doc_id, null ids among them, link
by their own texts only, never through the id. A component's id is the smallest doc_id in it,
null only when all are null. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import words
from tallyspark.llm.common import exact_digest, fresh_name, release, small_batches, stage
from tallyspark.operators.joins import broadcast_if_small, materialize_small

K = 5
PERCENT = 80
FREQUENT = 1 << 17  # elements whose counts are broadcast, at most
MIN_COUNT = 2  # counts below this in one stretch of rows are not summed
STRETCH = 1 << 21  # elements counted or listed together in a task
SHORT_LIST = 6
LIST_BLOCK = 1024
TILE = 16 << 20  # bytes of bitmaps compared at once
MAX_SMALL = 16  # largest boundary that the cost is evaluated for
LIST_COST = 3.0  # an entry of an inverted list against a subset: written, listed and paired
_TOP = np.uint64(1) << np.uint64(63)


# ------------------------------------------------------------------ sets
def needed_overlap(n: int, m: int) -> int:
    """Elements that sets of n and m must share to link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def linked(shared: int, n: int, m: int) -> bool:
    return 100 * shared >= PERCENT * (n + m - shared) and shared > 0


def compatible(n, m):
    """Sizes that can link at all."""
    return (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))


def prefix_length(n):
    return n + PERCENT * n // -100 + 1


def set_key(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def short_key(key: bytes) -> int:
    """The class's id in lists: two classes may share it, verification tells them apart."""
    return int.from_bytes(key[:8], "big", signed=True)


def parity_bitmap(elements: np.ndarray) -> bytes:
    """Parity of the number of elements per cell, with about one cell per element."""
    cells = min(1 << 16, max(64, 1 << int(len(elements) - 1).bit_length()))
    parity = np.bincount((elements & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def fold(bitmap: bytes, size: int) -> np.ndarray:
    """The same set's bitmap with fewer cells (``size`` bytes)."""
    return np.bitwise_xor.reduce(np.frombuffer(bitmap, np.uint8).reshape(-1, size), axis=0)


def may_link(n: int, a: bytes, m: int, b: bytes) -> bool:
    """False only for sets that cannot link: differing parities bound the symmetric difference."""
    if not compatible(n, m):
        return False
    size = min(len(a), len(b))
    differ = int(np.bitwise_count(fold(a, size) ^ fold(b, size)).sum())
    return differ <= n + m - 2 * needed_overlap(n, m)


# ------------------------------------------------------------------ small sets
@lru_cache(maxsize=None)
def subset_sizes(n: int, boundary: int) -> tuple[int, ...]:
    """Overlaps that a set of n needs with partners up to the boundary."""
    sizes = {needed_overlap(n, m) for m in range(1, boundary + 1) if compatible(n, m)}
    return tuple(sorted(c for c in sizes if c <= n))


def choose_boundary(histogram: dict[int, int]) -> int:
    """The size up to which enumerating subsets costs least, from ``size -> number of sets``."""

    def cost(x: int) -> float:
        subsets = sum(k * sum(comb(n, c) for c in subset_sizes(n, x)) for n, k in histogram.items() if n <= x)
        listed = sum(k * int(prefix_length(n)) for n, k in histogram.items() if n > x or 100 * n >= PERCENT * (x + 1))
        return subsets + LIST_COST * listed

    return min(range(MAX_SMALL + 1), key=lambda x: (cost(x), x))


def subset_tokens(elements: np.ndarray, boundary: int) -> list[tuple[int, int]]:
    """``(token, overlap)`` of every subset that a small set enumerates."""
    out = []
    for c in subset_sizes(len(elements), boundary):
        for picked in combinations(elements, c):
            out.append((int(words.shingle_hashes(np.array(picked, np.uint64), c)[0]), c))
    return out


# ------------------------------------------------------------------ lists
def ranked(elements: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Elements as numbers in the order of the lists: rare ones by hash, then the frequent
    ones by rank."""
    tokens, ranks = frequent
    out = elements >> np.uint64(1)
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, elements), len(tokens) - 1)
        out = np.where(tokens[at] == elements, _TOP | ranks[at], out)
    return out


def _stretches(batches: Iterator[pa.RecordBatch]):
    """Sets of the rows in stretches of about ``STRETCH`` elements: (ids, keys, sets)."""
    ids, sets, size = [], [], 0
    for batch in small_batches(batches):
        found = words.batch_shingle_sets(batch.column(batch.num_columns - 1).to_pylist(), K)
        at = 0
        for i, s in enumerate(found):
            sets.append(s)
            size += len(s)
            if size >= STRETCH:
                ids.append(batch.slice(at, i + 1 - at).column(0))
                yield ids, [set_key(x) for x in sets], sets
                ids, sets, size, at = [], [], 0, i + 1
        if at < batch.num_rows:
            ids.append(batch.slice(at).column(0))
    if sets:
        yield ids, [set_key(x) for x in sets], sets


def describe(docs: DataFrame, id_col: str, text_col: str, with_digest: bool = False) -> DataFrame:
    """A row per document (``doc_id, n, key, bitmap``) and a row per element that is frequent
    in a stretch (``element, seen``), told apart by ``n``. With ``with_digest``, ``doc_id`` is a
    struct of the id and the text's digest."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, keys, sets in _stretches(batches):
            rows = pa.chunked_array(ids).combine_chunks() if len(ids) > 1 else ids[0]
            n = len(sets)
            none = pa.nulls(n, pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            maps = pa.array([parity_bitmap(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([rows, sizes, pa.array(keys, pa.binary()), maps, none, none], names)
            distinct = dict(zip(keys, sets, strict=True))  # copies count once
            elements, seen = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            often = seen >= MIN_COUNT
            k = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(k, rows.type),
                    pa.nulls(k, pa.int64()),
                    pa.nulls(k, pa.binary()),
                    pa.nulls(k, pa.binary()),
                    pa.array(elements[often].view(np.int64)),
                    pa.array(seen[often].astype(np.int64)),
                ],
                names,
            )

    names = ["doc_id", "n", "key", "bitmap", "element", "seen"]
    doc_id = F.col(id_col).alias("doc_id")
    read = docs.select(F.struct(doc_id, exact_digest(F.col(text_col)).alias("digest")).alias("doc_id") if with_digest else doc_id, F.col(text_col).alias("text"))
    kinds = [read.schema["doc_id"].dataType, T.LongType(), T.BinaryType(), T.BinaryType(), T.LongType(), T.LongType()]
    schema = T.StructType([T.StructField(x, k) for x, k in zip(names, kinds, strict=True)])
    return read.mapInArrow(scan, schema)


def frequent_elements(described: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted frequent elements (at most ``FREQUENT``), their ranks by count, and the counts."""
    counts, path = stage(described.where("element is not null").groupBy("element").agg(F.sum("seen").alias("seen")), "elements")
    step = F.floor(F.log2("seen") * 8).cast("int")
    fits, least = 0, 1 << 20
    for s, n in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):  # at most 512 rows
        fits += n
        if fits > FREQUENT:
            break
        least = s
    rows = counts.where(step >= least).toArrow()
    release(described.sparkSession, path)
    elements, seen = rows["element"].to_numpy().view(np.uint64), rows["seen"].to_numpy()
    order = np.lexsort((elements, seen))
    ranks = np.empty(len(order), np.uint64)
    ranks[order] = np.arange(len(order), dtype=np.uint64)
    by_element = np.argsort(elements)
    return elements[by_element], ranks[by_element], seen[by_element]


def list_entries(docs: DataFrame, text_col: str, frequent, boundary: int, buckets: int) -> DataFrame:
    """Entries of the lists, packed by bucket of tokens (``bucket, tokens, overlaps``, and
    ``owners, sizes, runs``: an owner's entries in a bucket follow each other), and entries of
    the lists too long for one task (``list, owner, n, members``)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def entries_of(s: np.ndarray, order) -> tuple[np.ndarray, np.ndarray]:
        n, tokens, overlaps = len(s), [], []
        if n <= boundary:
            got = subset_tokens(s, boundary)
            tokens.append(np.array([t for t, _ in got], np.uint64))
            overlaps.append(np.array([c for _, c in got], np.int32))
        if n > boundary or 100 * n >= PERCENT * (boundary + 1):  # may link with a large set
            length = int(prefix_length(n))
            tokens.append(np.partition(ranked(s, order), length - 1)[:length])
            overlaps.append(np.zeros(length, np.int32))
        return np.concatenate(tokens), np.concatenate(overlaps)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        elements, ranks, counts = shared.value
        hot = np.zeros(len(counts) + 1, np.int64)  # by rank: the count of a hot element, else 0
        hot[ranks.astype(np.int64)] = np.where(counts > 4 * LIST_BLOCK, counts, 0)
        for _, keys, sets in _stretches(batches):
            distinct = {k: s for k, s in zip(keys, sets, strict=True) if len(s)}
            if not distinct:
                continue
            made = [entries_of(s, (elements, ranks)) for s in distinct.values()]
            per_set = [len(t) for t, _ in made]
            tokens, overlaps = np.concatenate([t for t, _ in made]), np.concatenate([c for _, c in made])
            owners = np.repeat(np.array([short_key(k) for k in distinct], np.int64), per_set)
            sizes = np.repeat(np.array([len(s) for s in distinct.values()], np.int32), per_set)
            rank = np.where((tokens & _TOP != 0) & (overlaps == 0), tokens & ~_TOP, np.uint64(len(counts)))
            members = hot[np.minimum(rank, np.uint64(len(counts))).astype(np.int64)]
            long = members > 0
            if long.any():
                k = int(long.sum())
                yield batch_of(
                    [pa.nulls(k, pa.int32()), *[pa.nulls(k, pa.binary())] * 5]
                    + [pa.array(tokens[long].view(np.int64)), pa.array(owners[long]), pa.array(sizes[long]), pa.array(members[long])]
                )
            tokens, owners, sizes, overlaps = (x[~long] for x in (tokens, owners, sizes, overlaps))
            bucket = (words.mix(tokens) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            tokens, owners, sizes, overlaps, bucket = (x[order] for x in (tokens, owners, sizes, overlaps, bucket))
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, int)
            ends = np.append(cuts[1:], len(bucket))
            k = len(cuts)
            first = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (owners[1:] != owners[:-1]))) if k else np.empty(0, bool)
            at = np.flatnonzero(first)
            runs = np.diff(np.append(at, len(bucket))).astype(np.int32)
            from_run, to_run = np.searchsorted(at, cuts), np.searchsorted(at, ends)
            packed = [
                pa.array([x[a:b].tobytes() for a, b in zip(lo, hi, strict=True)], pa.binary())
                for x, lo, hi in (
                    (tokens, cuts, ends),
                    (owners[at], from_run, to_run),
                    (sizes[at], from_run, to_run),
                    (runs, from_run, to_run),
                    (overlaps.astype(np.int8), cuts, ends),
                )
            ]
            none = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())]
            yield batch_of([pa.array(bucket[cuts]), *packed, *none])

    def batch_of(arrays) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["bucket", "tokens", "owners", "sizes", "runs", "overlaps", "list", "owner", "n", "members"]
    schema = "bucket int, tokens binary, owners binary, sizes binary, runs binary, overlaps binary, list long, owner long, n int, members long"
    return docs.select(F.col(text_col).alias("text")).mapInArrow(scan, schema)


def propose(entries: DataFrame, boundary: int) -> DataFrame:
    """From packed entries: proposed pairs (``a, b``) of the short lists and of the subsets, and
    the members of longer lists (``list, owner, n, members``)."""

    def pairs_of(owners: np.ndarray, sizes: np.ndarray, overlap: int):
        order = np.lexsort((owners, sizes))
        owners, sizes = owners[order], sizes[order]
        if overlap:  # a star from the smallest set: whoever links here links with it
            ok = [needed_overlap(int(sizes[0]), int(m)) <= overlap for m in sizes[1:]]
            return np.repeat(owners[0], sum(ok)), owners[1:][ok]
        i, j = np.triu_indices(len(owners), 1)
        ok = compatible(sizes[i], sizes[j]) & (sizes[j] > boundary)
        return owners[i[ok]], owners[j[ok]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for batch in batches:
            for i, kind in enumerate((np.uint64, np.int64, np.int32, np.int32, np.int8)):
                parts[i] += [np.frombuffer(x, kind) for x in batch.column(i).to_pylist()]
        if not parts[0]:
            return
        tokens, owners, sizes, runs, overlaps = (np.concatenate(p) for p in parts)
        owners, sizes = np.repeat(owners, runs), np.repeat(sizes, runs)
        order = np.lexsort((owners, tokens, overlaps))
        tokens, owners, sizes, overlaps = (x[order] for x in (tokens, owners, sizes, overlaps))
        new_list = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (overlaps[1:] != overlaps[:-1])))
        first = new_list | np.concatenate(([True], owners[1:] != owners[:-1]))  # an owner counts once in a list
        tokens, owners, sizes, overlaps = (x[first] for x in (tokens, owners, sizes, overlaps))
        starts = np.flatnonzero(np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (overlaps[1:] != overlaps[:-1]))))
        lengths = np.diff(np.append(starts, len(tokens)))
        two = starts[(lengths == 2) & (overlaps[starts] == 0)]
        ok = compatible(sizes[two], sizes[two + 1]) & (np.maximum(sizes[two], sizes[two + 1]) > boundary)
        left, right = [owners[two[ok]]], [owners[two[ok] + 1]]
        met: set[bytes] = set()
        for at, n in zip(starts[lengths > 1], lengths[lengths > 1], strict=True):
            overlap = int(overlaps[at])
            if n == 2 and not overlap:
                continue
            here = slice(at, at + n)
            sign = owners[here].tobytes()
            if not overlap and sign in met:  # the same members as an earlier list
                continue
            met.add(sign)
            if overlap or n <= SHORT_LIST:
                a, b = pairs_of(owners[here], sizes[here], overlap)
                left.append(a)
                right.append(b)
            else:
                yield batch_of(
                    [pa.nulls(n, pa.int64())] * 2
                    + [pa.array(np.repeat(tokens[at], n).view(np.int64)), pa.array(owners[here]), pa.array(sizes[here])]
                    + [pa.array(np.repeat(n, n).astype(np.int64))]
                )
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        none = pa.nulls(len(pairs), pa.int64())
        yield batch_of([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none, pa.nulls(len(pairs), pa.int32()), none])

    def batch_of(arrays) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(arrays, ["a", "b", "list", "owner", "n", "members"])

    packed = entries.where("bucket is not null").select("tokens", "owners", "sizes", "runs", "overlaps", "bucket")
    return packed.repartition("bucket").mapInArrow(scan, "a long, b long, list long, owner long, n int, members long")


# ------------------------------------------------------------------ long lists
def _distances(rows: list[bytes], others: list[bytes] | None = None) -> np.ndarray:
    """Differing parities of all pairs, on the smallest bitmap size among them. Bitmaps stay packed
    and meet in tiles, so beside them and the result no more than ``TILE`` bytes are held."""
    size = min(len(b) for b in rows + (others or []))
    packed = lambda part: np.stack([fold(b, size) for b in part]).view(np.uint64)
    x = packed(rows)
    y = x if others is None else packed(others)
    out = np.empty((len(x), len(y)), np.int32)
    step = max(1, TILE // (y.nbytes + 1))
    for at in range(0, len(x), step):
        out[at : at + step] = np.bitwise_count(x[at : at + step, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int32)
    return out


def near_pairs(members: DataFrame) -> DataFrame:
    """Each member with its nearest one and with the medoid, in two random blocks per list."""
    blocks = F.ceil(F.col("members") / LIST_BLOCK)
    salts = F.when(blocks > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    salted = members.withColumn("salt", F.explode(salts))
    cell = salted.withColumn("block", F.pmod(F.xxhash64("owner", "salt"), blocks))

    def choose(table: pa.Table) -> pa.Table:
        owners, sizes = table["owner"].to_numpy(), table["n"].to_numpy()
        far = _distances(table["bitmap"].to_pylist())
        far = np.where(compatible(sizes[:, None], sizes[None, :]), far, np.inf)
        medoid = int(np.argmin(np.where(np.isinf(far), 1e9, far).sum(1)))
        np.fill_diagonal(far, np.inf)
        nearest = far.argmin(1)
        i = np.arange(len(owners))
        a, b = np.concatenate((i, i)), np.concatenate((nearest, np.full(len(i), medoid)))
        ok = np.isfinite(far[a, b])
        a, b = owners[a[ok]], owners[b[ok]]
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return cell.groupBy("list", "salt", "block").applyInArrow(choose, "a long, b long")


def crossing_pairs(members: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every pair of members of different components that may link.

    Most members of a long list are of one component; of two members of different components, one
    is outside it. So the members outside the list's largest component, in blocks, meet all
    members, in blocks: a list of g members with r outside costs r * g comparisons, not g * g. The
    bitmaps are joined only to members of lists that hold several components."""
    sizes = members.groupBy("list", "component").agg(F.count(F.lit(1)).alias("held"))
    lists = sizes.groupBy("list").agg(
        F.max_by("component", F.struct("held", "component")).alias("largest"),
        F.sum("held").alias("all"),
        F.max("held").alias("most"),
    )
    # a row per list with several components: members meet it where they lie, if there are few
    lists = materialize_small(
        lists.where("most < all").select(
            "list",
            "largest",
            F.ceil((F.col("all") - F.col("most")) / LIST_BLOCK).alias("rows"),
            F.ceil(F.col("all") / LIST_BLOCK).alias("cols"),
        )
    )
    own = members.join(lists, "list").join(bitmaps.select("key", "bitmap"), "key")
    hashed = F.xxhash64("owner")
    across = own.where(F.col("component") != F.col("largest")).withColumn("row", F.pmod(hashed, "rows"))
    across = across.withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1))).withColumn("outside", F.lit(True))
    down = own.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    down = down.withColumn("col", F.pmod(hashed, "cols")).withColumn("outside", F.lit(False))
    columns = ("list", "row", "col", "outside", "owner", "n", "component", "bitmap")
    cells = across.select(*columns).unionByName(down.select(*columns))

    def cross(table: pa.Table) -> pa.Table:
        owners, sizes = table["owner"].to_numpy(), table["n"].to_numpy()
        parts = np.unique(table["component"].to_numpy(zero_copy_only=False), return_inverse=True)[1]
        outside = table["outside"].to_numpy()
        i, j = np.flatnonzero(outside), np.flatnonzero(~outside)
        if not len(i) or not len(j):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        rows = table["bitmap"].to_pylist()
        far = _distances([rows[x] for x in i], [rows[x] for x in j])
        n, m = sizes[i][:, None].astype(np.int64), sizes[j][None, :].astype(np.int64)
        most = n + m - 2 * (-(-PERCENT * (n + m) // (100 + PERCENT)))
        p, q = np.nonzero((far <= most) & compatible(n, m) & (parts[i][:, None] != parts[j][None, :]))
        a, b = owners[i[p]], owners[j[q]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return cells.groupBy("list", "row", "col").applyInArrow(cross, "a long, b long")


# ------------------------------------------------------------------ verification
def verify(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs that link, as ``left, right`` class keys. The proposed pairs are ``a, b``."""

    def filter_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, x, m, y = (batch.column(c).to_pylist() for c in ("n_left", "bitmap_left", "n_right", "bitmap_right"))
            ok = pa.array([may_link(*r) for r in zip(n, x, m, y, strict=True)], pa.bool_())
            yield batch.select(["left", "right"]).filter(ok)

    def side(name: str) -> DataFrame:
        return classes.select(F.col("short").alias(f"short_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "bitmap")], F.col("key").alias(name))

    proposed = pairs.where("a <> b").distinct()
    joined = proposed.join(side("left"), F.col("a") == F.col("short_left")).join(side("right"), F.col("b") == F.col("short_right"))
    joined = joined.select("left", "right", "n_left", "bitmap_left", "n_right", "bitmap_right")
    likely, path = stage(joined.mapInArrow(filter_pairs, "left binary, right binary"), "likely-pairs")

    keys = likely.select(F.col("left").alias("key")).union(likely.select("right")).distinct()
    wanted = classes.join(keys, "key", "left_semi").select(F.col("first_id").alias("wanted_id")).distinct()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            sets = words.batch_shingle_sets(batch.column(0).to_pylist(), K)
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "elements"]
            )

    sets, sets_path = stage(texts.mapInArrow(build, "key binary, elements binary"), "sets")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = int(np.isin(x, y, assume_unique=True, kind="sort").sum())
                keep.append(linked(shared, len(x), len(y)))
            yield batch.select(["left", "right"]).filter(pa.array(keep, pa.bool_()))

    right = sets.select(F.col("key").alias("right"), F.col("elements").alias("right_elements"))
    left = sets.select(F.col("key").alias("left"), F.col("elements").alias("left_elements"))
    both = likely.join(right, "right").join(left, "left").select("left", "right", "left_elements", "right_elements")
    links, _ = stage(both.mapInArrow(check, "left binary, right binary").distinct(), "links")
    release(docs.sparkSession, path, sets_path)
    return links


def connected(links: DataFrame) -> DataFrame:
    """``key, component`` (the smallest key) of every key in ``left, right``."""
    spark = links.sparkSession
    edges, edges_path = stage(
        links.union(links.select("right", "left")).toDF("key", "other").distinct(), "edges"
    )
    labels, path = stage(edges.groupBy("key").agg(F.least(F.min("other"), F.col("key")).alias("component")), "labels")
    while True:
        heard = edges.join(labels.withColumnRenamed("key", "other"), "other").groupBy("key").agg(F.min("component").alias("heard"))
        spread = labels.join(heard, "key").select("key", F.least("component", "heard").alias("next"), "component")
        jump = labels.select(F.col("key").alias("next"), F.col("component").alias("far"))
        moved = spread.join(jump, "next").select("key", F.least("next", "far").alias("component"), F.col("component").alias("was"))
        following, new_path = stage(moved, "labels")
        changed = following.where("component <> was").isEmpty()
        release(spark, path)
        labels, path = following.select("key", "component"), new_path
        if changed:
            release(spark, edges_path)
            return labels


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_keeper: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``; with ``with_keeper`` also its
    text's ``digest`` and the ``keeper`` (``no_id, doc_id, digest``) of its component."""
    spark = docs.sparkSession
    described, described_path = stage(describe(docs, id_col, text_col, with_keeper), "described")
    ids = ["doc_id.doc_id", "doc_id.digest"] if with_keeper else ["doc_id"]
    rows = described.where("n is not null").select(*ids, "n", "key", "bitmap")
    ids = ["doc_id", "digest"] if with_keeper else ["doc_id"]
    # the row that stays: smallest id, nulls last, then smallest digest
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), *ids)
    first = [F.min(place).alias("keeper")] if with_keeper else []
    classes, _ = stage(
        rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), *first),
        "classes",
    )
    classes = classes.withColumn("short", _long(F.col("key")))  # as short_key

    sizes = classes.where(F.col("n") <= 2 * MAX_SMALL).groupBy("n").count().collect()  # at most 2 * MAX_SMALL rows
    boundary = choose_boundary({r["n"]: r["count"] for r in sizes})
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_elements(described)
    rows, _ = stage(rows.select(*ids, "n", "key"), "rows")
    release(spark, described_path)  # the bitmaps are in the classes, the counts in the order
    entries, entries_path = stage(list_entries(docs, text_col, frequent, boundary, buckets), "entries")
    proposed, proposed_path = stage(propose(entries, boundary), "proposed")
    member_rows = proposed.where("list is not null").select("list", "owner", "n", "members").unionByName(
        entries.where("list is not null").select("list", "owner", "n", "members")
    )
    bitmaps = classes.select(F.col("short").alias("owner"), "key", "bitmap")
    members, members_path = stage(member_rows.distinct(), "members")
    release(spark, entries_path)

    pairs = proposed.where("a is not null").select("a", "b").union(near_pairs(members.join(bitmaps, "owner")))
    links = verify(docs, classes, pairs, id_col, text_col)
    labels = connected(links)
    known = members.join(bitmaps.select("owner", "key"), "owner").join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    crossing, _ = stage(crossing_pairs(known, bitmaps), "crossing")
    release(spark, proposed_path, members_path)
    if not crossing.isEmpty():
        more = verify(docs, classes, crossing, id_col, text_col)
        labels = connected(links.union(more))

    kept = ["keeper"] if with_keeper else []
    parts = classes.select("key", "first_id", *kept).join(labels, "key", "left").withColumn("component", F.coalesce("component", "key"))
    lowest = parts.groupBy("component").agg(F.min("first_id").alias("component_id"), *[F.min(c).alias(c) for c in kept])
    of_class = parts.select("key", "component").join(lowest, "component").select("key", "component_id", *kept)
    out = rows.select(*ids, "n", "key").join(of_class, "key", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        *(["digest", "keeper"] if with_keeper else []),
    )


def _long(first_bytes):
    """A signed long from eight big-endian bytes."""
    high = F.conv(F.hex(F.substring(first_bytes, 1, 4)), 16, 10).cast("long")
    low = F.conv(F.hex(F.substring(first_bytes, 5, 4)), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component stays, that with the smallest id; all columns are kept.

    Rows are addressed by id and text, so rows that share an id, null ids among them, go or stay
    each by its own text; among rows of the smallest id, the smallest digest stays. Rows that
    repeat an id and a text stay or go together. A row without shingles is a component of its
    own and stays.
    """
    found, _ = stage(components(docs, id_col, text_col, with_keeper=True), "components")
    stays = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("digest") == F.col("keeper.digest"))
    digest, key = fresh_name(docs.columns, "__digest"), fresh_name(docs.columns, "__id")
    goes = found.where((F.col("n_shingles") > 0) & ~stays).select(F.col("digest").alias(digest), F.col("doc_id").alias(key)).distinct()
    marked = docs.withColumn(digest, exact_digest(F.col(text_col)))
    on = (marked[digest] == goes[digest]) & marked[id_col].eqNullSafe(goes[key])
    return marked.join(goes, on, "left_anti").select(*docs.columns)
