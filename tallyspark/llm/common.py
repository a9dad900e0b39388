"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.scratch import new_folder
from tallyspark.session import scratch_path

#: White space and word classes of the contracts: space and ``\\x09-\\x0D`` only.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def fresh_name(columns, base: str) -> str:
    """``base``, or ``base`` with underscores appended until no column has that name
    (compared without case, as Spark resolves names)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the re-run of one stage's tasks, never the
    whole plan. Returns the reread table and its folder, for ``release``; folders that are not
    released go with the open ``Scratch``, or at exit.
    """
    spark = df.sparkSession
    path = new_folder(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Delete staged folders that nothing will read again (only paths made by ``stage``)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    prefix = scratch_path(spark, "llm") + "/"
    for path in paths:
        if not path.startswith(prefix):
            raise ValueError(f"not a staged folder: {path}")
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def word_count(text: Column) -> Column:
    """Number of words of a whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exact_digest(text: Column) -> Column:
    """SHA-256 of a text as it is; null for null."""
    return F.sha2(text.cast("binary"), 256)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(batches: Iterator[pa.RecordBatch], most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most_bytes`` (one row at least), so that what Python
    holds of a slice stays small whatever the session's batch size and however long the texts."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most_bytes / max(most_bytes, batch.nbytes)))
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            while part.num_rows > 1 and part.nbytes > 2 * most_bytes:
                part = batch.slice(at, part.num_rows // 2)
            yield part
            at += part.num_rows
