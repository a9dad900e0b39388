"""Process snapshots as a file stream (R1–R3).

A producer drops CSV snapshots (``pid, name, cpu_percent, memory_percent``, no header) whose
path carries the snapshot's epoch seconds (``sys_log<epoch>.csv`` or a ``sys_log=<epoch>/``
folder). The consumer is Structured Streaming: a file source with a fixed schema, a stateful
running aggregate (kept in the state store and recorded in the checkpoint, so a lost executor
or a restart resumes instead of re-reading), and a sink: a new version of the whole result per
micro-batch (complete mode, few keys), a log of changed rows with a compacted base (update mode,
many keys), the console, or the exactly-once Parquet file sink (append mode, no aggregation).

Totals of doubles are exact: the state holds integer limbs per process name and bin
(``partial_totals``), and readers of the result make the totals from them (``totals_of``), so the
order in which snapshots arrive changes no bit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyspark.functions.binned import final_totals, identity, partial_totals, state_names
from tallyspark.streaming.results import (
    COMPACT_EVERY,
    latest_per_key,
    read_changes,
    read_version,
    write_changes,
    write_version,
)

# The snapshot file layout.
SNAPSHOT_SCHEMA = "pid string, name string, cpu_percent double, memory_percent double"
SNAPSHOT_PREFIX = "sys_log"
MAX_AGE_SECONDS = 300
#: State stores of a stream, at most, unless the caller says otherwise.
STATE_PARTITIONS = 200
EPOCH_PATTERN = "/" + SNAPSHOT_PREFIX + r"=?(\d+(?:\.\d+)?)"


def with_snapshot_epoch(df: DataFrame, pattern: str = EPOCH_PATTERN, out: str = "snapshot_epoch") -> DataFrame:
    """Add the snapshot's epoch seconds with their fraction (double), read from the source
    file's name, or else from the name of the folder that holds it (``_metadata``)."""
    path = F.col("_metadata.file_path")
    of_file = F.regexp_extract(path, pattern + "[^/]*$", 1)
    of_folder = F.regexp_extract(path, pattern + "[^/]*/[^/]*$", 1)
    epoch = F.coalesce(F.nullif(of_file, F.lit("")), F.nullif(of_folder, F.lit("")))
    return df.withColumn(out, epoch.try_cast("double"))


def snapshot_stream(
    spark: SparkSession,
    path: str,
    schema: str = SNAPSHOT_SCHEMA,
    max_files_per_trigger: int | None = None,
    with_epoch: bool = True,
    clean_source: str | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming scan of snapshot CSV files under ``path`` (a folder or a glob).

    ``clean_source`` (``"archive"`` with ``archive_dir``, or ``"delete"``) lets the source
    retire files once a batch that read them is committed; this replaces deleting old
    snapshots by hand, and it is safe on restart because only committed files are retired.
    """
    reader = spark.readStream.schema(schema).option("header", "false")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    df = reader.csv(path)
    return with_snapshot_epoch(df) if with_epoch else df


def snapshot_batch(spark: SparkSession, path: str, schema: str = SNAPSHOT_SCHEMA, with_epoch: bool = True) -> DataFrame:
    """The same files as a batch scan (for backfills and checks)."""
    df = spark.read.schema(schema).option("header", "false").csv(path)
    return with_snapshot_epoch(df) if with_epoch else df


def running_totals(
    df: DataFrame,
    key: str = "name",
    measures: Sequence[str] = ("memory_percent",),
    prefix: str = "total_",
    sort: bool = True,
) -> DataFrame:
    """Exact sum of each measure per ``key`` over everything read so far, largest first by the
    first measure. On a stream the result is the aggregation's state, one row per key and bin of
    exponents, in any output mode; the sinks and ``totals_of`` make the totals from it, and
    ``by_total`` orders them on read, so no micro-batch pays for a global sort whose order a
    Parquet table would not keep."""
    state = partial_totals(df, [key], {prefix + m: m for m in measures})
    if df.isStreaming:
        return state
    totals = totals_of(state)
    return by_total(totals, measures, prefix) if sort else totals


def totals_of(state: DataFrame) -> DataFrame:
    """Totals from the rows of ``running_totals`` on a stream; other frames pass unchanged."""
    outs = state_names(state)
    keys = [c for c in state.columns if not any(c.startswith(out + "__") for out in outs)]
    return final_totals(state, keys) if outs else state


def by_total(totals: DataFrame, measures: Sequence[str] = ("memory_percent",), prefix: str = "total_") -> DataFrame:
    """Running totals ordered largest first by the first measure."""
    return totals.orderBy(F.col(prefix + measures[0]).desc())


def fresh_snapshots(
    df: DataFrame,
    as_of_epoch: float | None,
    max_age_seconds: float = MAX_AGE_SECONDS,
    epoch: str = "snapshot_epoch",
) -> DataFrame:
    """Rows of snapshots at most ``max_age_seconds`` old at ``as_of_epoch`` (a snapshot exactly
    that old is kept). ``None`` means the wall clock, read once per query or micro-batch.
    Works on batch and streaming frames alike; pair it with the file source's
    ``cleanSource`` option to archive consumed files instead of deleting by hand."""
    now = F.unix_timestamp() if as_of_epoch is None else F.lit(as_of_epoch)
    return df.filter(now - F.col(epoch) <= F.lit(max_age_seconds))


def write_snapshot_files(df: DataFrame, path: str, epoch: str = "snapshot_epoch") -> None:
    """Write one CSV folder per snapshot epoch (``<path>/sys_log=<epoch>/``), with a file from each
    task that holds rows of it: a snapshot is neither gathered in one task nor limited to one
    file. Used to replay a table as a producer would have dropped it."""
    df.withColumnRenamed(epoch, SNAPSHOT_PREFIX).write.partitionBy(SNAPSHOT_PREFIX).option("header", "false").csv(path)


@contextmanager
def few_state_stores(spark: SparkSession, most: int = STATE_PARTITIONS) -> Iterator[None]:
    """Start a stateful stream inside this block: it gets at most ``most`` state stores.

    A stream fixes its number of stores to the shuffle partitions of its first start and AQE
    does not coalesce them, so a count sized for batch shuffles of many terabytes would open
    as many stores in every micro-batch. The session's value is put back at the end.
    """
    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    spark.conf.set(key, str(min(int(was), most)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def start_totals(
    df: DataFrame,
    output_path: str | None,
    checkpoint_path: str,
    mode: str = "complete",
    key: str = "name",
    trigger: dict | None = None,
    state_partitions: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start a streaming aggregate and return its query.

    ``mode`` is ``complete`` (each micro-batch publishes the whole result as a new version, read
    with ``read_version``), ``update`` (it publishes the changed rows, read with ``read_totals``; a
    batch costs what it changes), or ``console`` (the whole result is printed, without a path).
    ``trigger`` holds the arguments of the writer's trigger, ``availableNow`` by default. At most
    ``state_partitions`` state stores are opened (``STATE_PARTITIONS`` if not given).
    """
    if mode not in ("complete", "update", "console"):
        raise ValueError(f"unknown mode {mode!r}")
    keys = identity(df, [key])

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        if mode == "complete":
            write_version(totals_of(batch), output_path, batch_id)
        elif mode == "update":
            write_changes(batch, output_path, batch_id, keys, compact_every)
        else:
            totals_of(batch).show(truncate=False)

    writer = df.writeStream.outputMode("update" if mode == "update" else "complete").foreachBatch(publish_batch)
    writer = writer.option("checkpointLocation", checkpoint_path).trigger(**(trigger or {"availableNow": True}))
    spark = df.sparkSession
    with few_state_stores(spark) if state_partitions is None else few_state_stores(spark, state_partitions):
        return writer.start()


def run_complete(df: DataFrame, output_path: str, checkpoint_path: str, state_partitions: int | None = None) -> DataFrame:
    """Drive a streaming aggregate over all available files, publishing the whole result as a new
    version after each micro-batch; return the newest one."""
    start_totals(df, output_path, checkpoint_path, state_partitions=state_partitions).awaitTermination()
    return read_version(df.sparkSession, output_path)


def run_update(
    df: DataFrame,
    output_path: str,
    checkpoint_path: str,
    key: str = "name",
    state_partitions: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Drive a streaming aggregate in *update* mode: each micro-batch publishes only the rows that
    changed, so a batch costs O(changed keys) instead of rewriting the whole state as complete
    mode does, and the log is compacted every ``compact_every`` batches. Returns the current
    totals."""
    query = start_totals(
        df, output_path, checkpoint_path, "update", key, state_partitions=state_partitions, compact_every=compact_every
    )
    query.awaitTermination()
    return read_totals(df.sparkSession, output_path, identity(df, [key]))


def read_totals(spark: SparkSession, output_path: str, key) -> DataFrame:
    """The current totals of an update log."""
    return totals_of(read_changes(spark, output_path, key))


def run_append(df: DataFrame, output_path: str, checkpoint_path: str) -> DataFrame:
    """Drive a stateless stream over all available files into the exactly-once Parquet file
    sink; return the committed table."""
    query = (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return df.sparkSession.read.parquet(output_path)


__all__ = [
    "by_total",
    "EPOCH_PATTERN",
    "MAX_AGE_SECONDS",
    "SNAPSHOT_SCHEMA",
    "few_state_stores",
    "fresh_snapshots",
    "latest_per_key",
    "read_totals",
    "read_version",
    "run_append",
    "run_complete",
    "run_update",
    "running_totals",
    "snapshot_batch",
    "snapshot_stream",
    "start_totals",
    "totals_of",
    "with_snapshot_epoch",
    "write_snapshot_files",
]
