"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Each source gets its weight's share of ``budget`` times all words, but no more than
``max_epochs`` times its own size. Sources over that cap are clamped to it and the excess is
shared again among the others in proportion to their weights, until none is over its cap. All
sums are of integers, so targets do not depend on partitioning.

A source's target is met by whole repetitions of every document plus one fractional
repetition: documents are taken in the order of a seeded hash until the remaining words are
reached, and the last one gives only the words still missing. The running sums are found
without a window over a source's rows: sizes are summed per (source, leading hash digits), a
window runs over those few sums, and only the one bucket that crosses the target is looked at
row by row.

Size is the number of ``[^\\x20\\x09-\\x0D]+``; null text has size 0. A null source is a source
of its own, last in order. Rows with the same hash are ordered by doc_id and size, so rows that
repeat give the same multiset of results. Empty tables give empty results. Only the id, text
and source columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm.common import exact_digest, fresh_name, stage, word_count
from tallyspark.operators.joins import broadcast_if_small

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
BUCKET_DIGITS = 3


def order_hash(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """``source, source_size, weight, target`` from rows of ``source, size``.

    ``weights`` repeats over the sources in code point order (nulls last); its length and the
    number of clamping rounds are small, and each round is one aggregate over one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source: numbering them is the only step that puts them in one task
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    numbered, _ = stage(
        per_source.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * max_epochs), "sources"
    )
    total = numbered.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = None, F.lit(False)
    while True:
        caps, free = numbered.agg(
            F.coalesce(F.sum(F.when(clamped, F.col("cap"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0)),
        ).first()
        new_level = (budget * total - caps) / free if free else None
        if new_level is None or new_level == level:
            break
        level = new_level
        # clamped sources stay clamped: the level only rises
        clamped = F.lit(level) * F.col("weight") >= F.col("cap")
    share = F.lit(level) * F.col("weight") if level is not None else F.col("cap").cast("double")
    target = F.when(share >= F.col("cap"), F.col("cap").cast("double")).otherwise(share)
    return numbered.select("source", "source_size", "weight", target.cast("double").alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (and ``source``,
    ``repeats`` whole repetitions, ``extra`` words of the fractional one)."""
    return _mix(docs, id_col, text_col, source_col, weights, budget, max_epochs, seed, [])


def _mix(docs, id_col, text_col, source_col, weights, budget, max_epochs, seed, more: list[Column]) -> DataFrame:
    """``mix`` with the columns ``more``, which also order rows of one hash, id and size."""
    extra_names = docs.select(*more).columns if more else []
    rows, _ = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            order_hash(F.col(id_col), seed).alias("hash"),
            *more,
        ),
        "sizes",
    )
    targets, _ = stage(source_targets(rows.select("source", "size"), weights, budget, max_epochs), "targets")
    plan = targets.withColumn(
        "repeats", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    ).withColumn("rest", F.floor(F.col("target") - F.col("repeats") * F.col("source_size") + 0.5).cast("long"))

    bucket = F.substring("hash", 1, BUCKET_DIGITS)
    sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    sums = sums.withColumn("before", before)
    same = sums["source"].eqNullSafe(plan["source"])
    crossing = (
        sums.join(broadcast_if_small(plan), same)
        .where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
        .select(sums["source"].alias("at_source"), F.col("bucket").alias("at_bucket"), F.col("before").alias("at_before"))
    )
    same = plan["source"].eqNullSafe(crossing["at_source"])
    # without a crossing bucket the rest ends between two buckets: those before it are whole
    ends = sums.join(broadcast_if_small(plan), sums["source"].eqNullSafe(plan["source"])).where(
        F.col("before") + F.col("words") <= F.col("rest")
    )
    ends = ends.groupBy(sums["source"].alias("end_source")).agg(F.max("bucket").alias("last_whole"))
    plan = plan.join(crossing, same, "left")
    plan = plan.join(ends, plan["source"].eqNullSafe(ends["end_source"]), "left").drop("end_source", "at_source")
    plan, _ = stage(plan.coalesce(1), "mix-plan")

    plan = plan.withColumnRenamed("source", "plan_source")
    placed = rows.join(broadcast_if_small(plan), rows["source"].eqNullSafe(F.col("plan_source"))).withColumn("bucket", bucket)
    crosses = F.coalesce(F.col("bucket") == F.col("at_bucket"), F.lit(False))
    easy = placed.where(~crosses).withColumn(
        "extra", F.when(F.col("bucket") <= F.col("last_whole"), F.col("size")).otherwise(0).cast("long")
    )
    order = Window.partitionBy("source", "bucket").orderBy("hash", "doc_id", "size", *extra_names).rowsBetween(Window.unboundedPreceding, 0)
    missing = F.col("rest") - F.col("at_before") - (F.sum("size").over(order) - F.col("size"))
    close = placed.where(crosses).withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least("size", missing)))
    out = easy.unionByName(close)
    return out.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("repeats") * F.col("size") + F.col("extra")).alias("taken"),
        "source",
        "repeats",
        "extra",
        *extra_names,
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    budget: float = BUDGET,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The mixture itself: each document as often as the mix takes it, columns unchanged. The
    one document per source that is taken in part is there when at least half of it is taken.

    Repetitions are those of a row's id, source and text. Rows that agree in all three share
    theirs, and what does not divide evenly goes to the first of them.
    """
    taken = _mix(docs, id_col, text_col, source_col, weights, budget, max_epochs, seed, [exact_digest(F.col(text_col)).alias("digest")])
    times = F.col("repeats") + F.when((F.col("extra") > 0) & (2 * F.col("extra") >= F.col("size")), 1).otherwise(0)
    names = ["__mix_id", "__mix_source", "__mix_digest", "__times", "__over", "__digest"]
    key, source, sha, n, over, digest = (fresh_name(docs.columns, x) for x in names)
    picks = taken.groupBy(F.col("doc_id").alias(key), F.col("source").alias(source), F.col("digest").alias(sha))
    picks = picks.agg(F.sum(times).alias("total"), F.count(F.lit(1)).alias("rows")).where(F.col("total") > 0)
    whole = F.floor(F.col("total") / F.col("rows")).cast("int").alias(n)
    picks, _ = stage(picks.select(key, source, sha, whole, (F.col("total") % F.col("rows")).alias(over)), "picks")

    marked = docs.withColumn(digest, exact_digest(F.col(text_col)))
    same = marked[id_col].eqNullSafe(picks[key]) & marked[source_col].eqNullSafe(picks[source]) & marked[digest].eqNullSafe(picks[sha])
    joined = marked.join(picks, same)
    repeated = joined.where(F.col(over) == 0)
    if not picks.where(F.col(over) > 0).isEmpty():  # only equal rows in which a source's target ends
        order = Window.partitionBy(key, source, sha).orderBy(F.xxhash64(*[joined[c] for c, t in docs.dtypes if not t.startswith("map")]))
        uneven = joined.where(F.col(over) > 0).withColumn(over, (F.row_number().over(order) <= F.col(over)).cast("int"))
        repeated = repeated.unionByName(uneven.withColumn(n, F.col(n) + F.col(over)))
    repeated = repeated.withColumn(n, F.explode(F.array_repeat(F.lit(1), F.col(n))))
    return repeated.select(*[repeated[c] for c in docs.columns])
