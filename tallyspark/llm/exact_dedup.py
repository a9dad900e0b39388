"""Exact de-duplication with a heavy-hitter split.

Digests that hold many rows would all meet in one task of an ordinary shuffle. A mergeable
Misra-Gries summary (``counters`` counters per task, summed by digest) finds every digest with
at least ``2 / counters`` of the rows, and no more than ``counters`` digests in all, because a
summary never overcounts. The exact winners of those few digests are computed with partial
aggregates and broadcast, so heavy rows are settled map-side; all other digests take an
ordinary shuffle of narrow rows, in which no digest holds more than ``2 / counters`` of them.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space; null
counts as empty. The row with the smallest doc_id stays. Rows that tie on text and doc_id are
numbered: the first stays, the others are dropped. A null doc_id sorts last. Empty input gives
an empty result. Only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import SPACE_RUN, fresh_name, stage

COUNTERS = 1000


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the normalised text."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " "), 256)


def merge_counts(held: pd.Series, more: pd.Series, counters: int) -> pd.Series:
    """Misra-Gries merge: add, then subtract the largest count that does not fit and keep
    what is left. The sum of all counts never exceeds the number of rows seen."""
    both = held.add(more, fill_value=0).astype("int64")
    if len(both) > counters:
        both = both - both.nlargest(counters + 1).iloc[-1]
        both = both[both > 0]
    return both


def frequent_digests(rows: DataFrame, digest: str, counters: int) -> DataFrame:
    """At most ``counters`` digests, among them each one with ``2 / counters`` of the rows."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for batch in batches:
            held = merge_counts(held, batch.iloc[:, 0].value_counts(), counters)
        yield pd.DataFrame({"digest": held.index.astype(str), "at_least": held.to_numpy("int64")})

    parts = rows.select(F.col(digest).alias("digest")).mapInPandas(summarise, "digest string, at_least long")
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    return (
        parts.groupBy("digest")
        .agg(F.sum("at_least").alias("at_least"))
        .where(F.col("at_least") * counters >= total.scalar())
        .select("digest")
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows, _ = stage(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest")), "digests"
    )
    heavy, _ = stage(frequent_digests(rows, "digest", counters).coalesce(1), "heavy-digests")

    def winners(part: DataFrame) -> DataFrame:
        return part.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))

    def identical(part: DataFrame, *more: str) -> DataFrame:
        """(digest, doc_id) with its number of identical rows: 1 unless rows repeat."""
        return part.groupBy("digest", "doc_id", *more).agg(F.count(F.lit(1)).alias("copies"))

    top, _ = stage(winners(rows.join(F.broadcast(heavy), "digest")).coalesce(1), "heavy-winners")  # <= counters rows
    # heavy rows meet their winner where they lie; only those equal to it are counted
    settled = rows.join(F.broadcast(top), "digest")
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    dropped = settled.where(~wins).withColumn("kept", F.lit(False))
    tied = numbered(identical(settled.where(wins), "keep_id", "group_size"))
    light = rows.join(F.broadcast(heavy), "digest", "left_anti")
    shuffled = numbered(identical(light).join(winners(light), "digest"))
    both = dropped.unionByName(tied).unionByName(shuffled)
    return both.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def numbered(counted: DataFrame) -> DataFrame:
    """The rows counted in ``copies``, of which the first stays where its id is the winner's."""
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("digest", "doc_id", "keep_id", "group_size", stays.alias("kept"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The documents that stay, with all their columns."""
    groups, _ = stage(duplicate_groups(docs, id_col, text_col, counters), "groups")
    digest, key = fresh_name(docs.columns, "__digest"), fresh_name(docs.columns, "__id")
    stays = groups.where("kept").select(F.col("text_sha256").alias(digest), F.col("doc_id").alias(key))
    goes = groups.where("not kept").select(F.col("text_sha256").alias(digest), F.col("doc_id").alias(key)).distinct()
    # rows that repeat an id and a text are in both lists; one of each such pair stays
    repeated = goes.join(stays, (goes[digest] == stays[digest]) & goes[key].eqNullSafe(stays[key]), "left_semi")
    marked = docs.withColumn(digest, text_digest(F.col(text_col)))
    on = (marked[digest] == goes[digest]) & marked[id_col].eqNullSafe(goes[key])
    kept = marked.join(goes, on, "left_anti")
    if not repeated.isEmpty():
        on = (marked[digest] == repeated[digest]) & marked[id_col].eqNullSafe(repeated[key])
        kept = kept.unionByName(marked.join(repeated, on, "left_semi").dropDuplicates([digest, id_col]))
    return kept.select(*[kept[c] for c in docs.columns])
