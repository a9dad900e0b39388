"""Join helpers: broadcast only behind a size check, staged intermediates, null-safe key joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.functions.columns import null_safe_on

# Largest side hinted for broadcast, in rows and in estimated bytes (string lengths, the
# content of nested values, and a fixed width per other value). Above either bound the join falls back to the planner: a
# sort-merge join, or a broadcast that AQE picks from measured shuffle sizes.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

#: Keys that are split off a shuffle at most: those with more than this share of one of the rows.
HEAVY_KEYS = 1000

_FIXED_WIDTH = 8
_NESTED_FACTOR = 4  # a value takes at least two characters as JSON and eight bytes in a row


def _value_bytes(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(c))) * F.lit(_NESTED_FACTOR)  # by content
    return F.lit(_FIXED_WIDTH)


def size_probe(df: DataFrame) -> list[Column]:
    """Aggregates giving a frame's row count and estimated bytes in one pass."""
    width = sum((_value_bytes(f) for f in df.schema.fields), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


def fits_broadcast(rows: int, nbytes: int, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    return rows <= max_rows and nbytes <= max_bytes


def broadcast_if_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Hint ``df`` for broadcast only if it holds at most ``max_rows`` rows and about
    ``max_bytes`` bytes.

    The check is one distributed aggregate (partial count and byte sum per task, one row
    per task to the final), so it scales with the table. A ``limit(n)`` under the aggregate
    would funnel up to ``n`` rows from every task into a single partition. Use it for
    dimension tables read from storage; for an aggregate computed inside the same plan use
    ``materialize_small``, which computes it only once.
    """
    probe = df.agg(*size_probe(df)).first()
    return F.broadcast(df) if fits_broadcast(probe["rows"], probe["bytes"], max_rows, max_bytes) else df


def stage(df: DataFrame) -> tuple[DataFrame, int]:
    """Write ``df`` once as Parquet under the shared checkpoint folder and return the scan of
    that table with its row count, observed during the write (no second job). The folder belongs
    to the open ``Scratch``.

    Use it where one intermediate feeds several branches of a plan whose column sets
    differ (Spark cannot reuse their exchanges, so the intermediate would be recomputed per
    branch), and to cut a long lineage so a lost executor does not recompute it.
    """
    saved, rows, _ = _stage(df)
    return saved, rows


def _stage(df: DataFrame) -> tuple[DataFrame, int, int]:
    from tallyspark.scratch import new_folder

    spark = df.sparkSession
    path = new_folder(spark, "stages", "table")
    size = Observation()
    df.observe(size, *size_probe(df)).write.mode("overwrite").parquet(path)
    got = size.get
    return spark.read.schema(df.schema).parquet(path), int(got["rows"]), int(got["bytes"])


def settle(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> tuple[DataFrame, bool]:
    """Settle the join strategy for an aggregate computed inside a plan before the big side runs.

    Left to the planner, such an aggregate is estimated at about its input's size, so a
    sort-merge join is planned and the big side is shuffled even when AQE later finds the
    aggregate tiny. Here the aggregate is written once as a Parquet table in the shared
    checkpoint folder (one job; its lineage is cut, so a lost executor does not recompute
    it); its rows and bytes are observed during that same write (``Observation``), and it is
    hinted for broadcast only within both bounds. Otherwise the written table feeds an
    ordinary shuffle join. Returns the table and whether it is broadcast.
    """
    saved, rows, nbytes = _stage(df)
    small = fits_broadcast(rows, nbytes, max_rows, max_bytes)
    return (F.broadcast(saved) if small else saved), small


def materialize_small(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """``settle`` for callers that join the table either way."""
    return settle(df, max_rows, max_bytes)[0]


def join_dimension(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    heavy_keys: int = HEAVY_KEYS,
    distinct: bool = False,
) -> DataFrame:
    """Inner join of facts to a dimension; the dimension's key column is dropped.

    Within the bounds the dimension is broadcast. Beyond them the facts must be shuffled by the
    key, and a key that holds a third of them would meet in one task. So the keys with more than
    about ``1 / heavy_keys`` of the facts (at most ``heavy_keys`` of them, found by a sketch of
    bounded size over all facts) are split off: their dimension rows are few and are broadcast, and
    their facts stay where they lie. Only the others are shuffled, once. Which keys are split off
    does not change the result.

    With ``distinct`` equal result rows count once. The shuffled rows then lie by their key and are
    de-duplicated there, without another shuffle.
    """
    probe = dim.agg(*size_probe(dim)).first()
    dim = dim.withColumnRenamed(dim_key, "__dim_key")
    on = F.col(fact_key) == F.col("__dim_key")

    def joined(facts: DataFrame, dim: DataFrame) -> DataFrame:
        out = facts.join(dim, on, "inner").drop("__dim_key")
        return out.dropDuplicates() if distinct else out

    if fits_broadcast(probe["rows"], probe["bytes"], max_rows, max_bytes):
        return joined(facts, F.broadcast(dim))
    heavy, n, nbytes = _stage(_frequent_keys(facts, fact_key, heavy_keys))
    if n == 0 or not fits_broadcast(n, nbytes, heavy_keys, max_bytes):  # none, or keys too wide
        return joined(facts, dim)
    theirs, few = settle(dim.join(F.broadcast(heavy), F.col("__dim_key") == F.col("__heavy"), "left_semi"))
    if not few:  # a dimension that repeats its heavy keys too often
        return joined(facts, dim)
    rest = facts.join(F.broadcast(heavy), F.col(fact_key) == F.col("__heavy"), "left_anti")
    return joined(facts, theirs).unionByName(joined(rest, dim))


#: Keys that the sketch counts per wanted key: its error is a few parts in this many.
_TRACKED = 10


def _frequent_keys(facts: DataFrame, key: str, most: int) -> DataFrame:
    """The keys (``__heavy``) with more than about ``1 / most`` of the facts. Tasks pass on sketches,
    not their keys; keys that sketches do not take (binary, nested) are counted exactly."""
    keys = facts.select(F.col(key).alias("__heavy")).where(F.col("__heavy").isNotNull())
    if isinstance(facts.schema[key].dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
        per_key = keys.groupBy("__heavy").agg(F.count(F.lit(1)).alias("__n"))
        total = per_key.select(F.sum("__n")).scalar()
        return per_key.where(F.col("__n") * F.lit(most) > total).select("__heavy")
    top = keys.agg(F.call_function("approx_top_k", "__heavy", F.lit(most), F.lit(most * _TRACKED)).alias("__top"), F.count(F.lit(1)).alias("__total"))
    top = top.select(F.explode("__top").alias("__top"), "__total")
    return top.where(F.col("__top.count") * F.lit(most) > F.col("__total")).select(F.col("__top.item").alias("__heavy"))


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    null_safe: bool = True,
) -> DataFrame:
    """Equi-join on same-named keys, keeping one copy of each key column.

    With ``null_safe`` the keys match with ``<=>``, which is how a group-by or window
    partition treats a null key; Spark plans it as an ordinary hash/sort-merge key.
    """
    keys = list(keys)
    if not null_safe:
        return left.join(right, on=keys, how=how)
    renamed = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__right_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(renamed, on=cond, how=how)
    if how in ("left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti"):
        return joined
    return joined.drop(*[f"__right_{k}" for k in keys])


def total_order(df: DataFrame, *leading) -> list[Column]:
    """Sort keys that order by ``leading`` and then by every other column. A global sort
    range-partitions on its keys and cannot split rows with equal keys; refining the order
    with the remaining columns lets a hot key spread over several range partitions."""
    lead = [c if isinstance(c, Column) else F.col(c) for c in leading]
    names = {c for c in leading if isinstance(c, str)}
    unsortable = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    rest = [
        F.col(f"`{f.name}`")
        for f in df.schema.fields
        if f.name not in names and not isinstance(f.dataType, unsortable)
    ]
    return lead + rest


__all__ = [
    "BROADCAST_MAX_BYTES",
    "BROADCAST_MAX_ROWS",
    "broadcast_if_small",
    "fits_broadcast",
    "join_dimension",
    "join_on_keys",
    "materialize_small",
    "null_safe_on",
    "settle",
    "size_probe",
    "stage",
    "total_order",
]
