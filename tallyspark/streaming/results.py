"""Where a stream's batches go: whole results by version, or a log of changes with a compacted base.

A batch is written into a folder of its own by Spark's committer, ``<part>=<batch>/copy-<unique>/``, and
counts once its ``_SUCCESS`` marker is there. Nothing that a reader may hold is overwritten: a batch
that fails halfway, or is run again, leaves what was readable before. Batches of one number hold
equal rows, so any complete copy of it serves. A path has one writing stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.sources.files import complete_copy, delete_folder, list_names, write_copy

#: Complete versions of a result that are kept: the newest, and one that a slow reader may hold.
KEPT_VERSIONS = 2
#: Batches between two compactions of a change log.
COMPACT_EVERY = 20

VERSION, CHANGES, BASE = "version", "batch_id", "through"


def numbered(spark: SparkSession, path: str, part: str) -> dict[int, str]:
    """The complete folders ``<part>=<number>`` under ``path``, by number."""
    found = {}
    for name in list_names(spark, path):
        label, _, number = name.partition("=")
        if label == part and number.isdigit():
            done = complete_copy(spark, f"{path}/{name}")
            if done:
                found[int(number)] = done
    return found


def write_version(batch: DataFrame, path: str, batch_id: int, keep: int = KEPT_VERSIONS) -> None:
    """Publish a batch's whole result as version ``batch_id``; older versions beyond ``keep`` go."""
    spark = batch.sparkSession
    write_copy(spark, f"{path}/{VERSION}={batch_id}", lambda folder: batch.write.parquet(folder))
    for old in sorted(numbered(spark, path, VERSION))[: -max(1, keep)]:
        delete_folder(spark, f"{path}/{VERSION}={old}")


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version."""
    versions = numbered(spark, path, VERSION)
    if not versions:
        raise FileNotFoundError(f"{path} holds no complete version")
    return spark.read.parquet(versions[max(versions)])


def latest_per_key(changes: DataFrame, key="name", version: str = CHANGES) -> DataFrame:
    """The newest row per key (one or several columns) of an update log: one distributed aggregate
    (``max_by`` per column), partial per task, so a key with many versions is reduced map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in changes.columns if c not in (*keys, version)]
    return changes.groupBy(*keys).agg(*[F.max_by(c, version).alias(c) for c in values])


def write_changes(batch: DataFrame, path: str, batch_id: int, key, compact_every: int = COMPACT_EVERY) -> None:
    """Publish the rows a batch changed; every ``compact_every`` batches the log is compacted."""
    spark = batch.sparkSession
    write_copy(spark, f"{path}/{CHANGES}={batch_id}", lambda folder: batch.write.parquet(folder))
    if compact_every and (batch_id + 1) % compact_every == 0:
        compact(spark, path, batch_id, key)


def _log(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """The base's watermark and, tagged with their numbers, its rows and the changes after it. The
    changes are one scan, numbered by their folders' names."""
    bases, changes = numbered(spark, path + "-base", BASE), numbered(spark, path, CHANGES)
    through, rows = max(bases, default=-1), None
    if bases:
        rows = spark.read.parquet(bases[through]).withColumn(CHANGES, F.lit(through).cast("long"))
    later = [folder for n, folder in sorted(changes.items()) if n > through]
    if later:
        number = F.regexp_extract("_metadata.file_path", CHANGES + "(?:=|%3D)([0-9]+)/[^/]*/[^/]*$", 1).cast("long")
        scan = spark.read.parquet(*later)
        scan = scan.select(*scan.columns, number.alias(CHANGES))
        rows = scan if rows is None else rows.unionByName(scan)
    return through, rows


def compact(spark: SparkSession, path: str, through: int, key) -> None:
    """Merge base and changes up to batch ``through`` into a new base that carries that number,
    then delete what the base before it covered.

    Readers use the newest complete base and only the changes after its number. So a compaction
    that stops anywhere leaves a readable log, a batch that is run again after its compaction adds a
    folder no reader looks at, and a reader of the base before finds all its folders. The log
    never holds more than the changes of two compactions."""
    held, rows = _log(spark, path)
    if rows is None or held >= through:
        return
    merged = latest_per_key(rows.where(F.col(CHANGES) <= through), key).drop(CHANGES)
    write_copy(spark, f"{path}-base/{BASE}={through}", lambda folder: merged.write.parquet(folder))
    for n in numbered(spark, path, CHANGES):
        if n <= held:
            delete_folder(spark, f"{path}/{CHANGES}={n}")
    for n in numbered(spark, path + "-base", BASE):
        if n < held:
            delete_folder(spark, f"{path}-base/{BASE}={n}")


def read_changes(spark: SparkSession, path: str, key) -> DataFrame:
    """The current row per key: base and later changes, at most one base row and
    ``COMPACT_EVERY`` changes a key."""
    _, rows = _log(spark, path)
    if rows is None:
        raise FileNotFoundError(f"{path} holds no complete batch")
    return latest_per_key(rows, key)


__all__ = [
    "COMPACT_EVERY",
    "KEPT_VERSIONS",
    "compact",
    "latest_per_key",
    "read_changes",
    "read_version",
    "write_changes",
    "write_version",
]
