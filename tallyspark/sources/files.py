"""File ingest (I1–I4): CSV scans, header normalisation, a one-time Parquet copy, and a
directory of CSV tables loaded as a dictionary.

Existence checks go through the Hadoop ``FileSystem`` of the path (HDFS, object stores,
local), never the driver's local disk. A copy is written by Spark's committer into a folder of
its own, ``<path>/copy-<unique>/``, and never moved or changed: its ``_SUCCESS`` marker publishes it,
so nothing depends on a rename, which object stores do not have. Of several complete copies (rival
writers) readers take the one that was complete first; a writer that finds an earlier one deletes
its own. A copy without the marker (an interrupted writer) is never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

COPY_PREFIX = "copy-"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return bool(fs.exists(hpath))


def content_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path``, from file-system metadata (no job)."""
    fs, hpath = _hadoop(spark, path)
    return int(fs.getContentSummary(hpath).getLength()) if fs.exists(hpath) else 0


def has_marker(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to the folder ``path`` finished (its ``_SUCCESS`` marker exists)."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def complete_copy(spark: SparkSession, path: str) -> str | None:
    """The folder to read for ``path``: itself if a Spark write to it finished, else the copy
    inside it that was complete first, else nothing."""
    path = path.rstrip("/")
    if has_marker(spark, path):
        return path
    fs, _ = _hadoop(spark, path)
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    done = []
    for name in list_names(spark, path):
        marker = to_path(f"{path}/{name}/_SUCCESS")
        if name.startswith(COPY_PREFIX) and fs.exists(marker):
            done.append((int(fs.getFileStatus(marker).getModificationTime()), name))
    return f"{path}/{min(done)[1]}" if done else None


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when there is a complete copy at ``path``."""
    return complete_copy(spark, path) is not None


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (files and directories)."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(hpath))


def read_csv(
    spark: SparkSession,
    path: str,
    schema=None,
    header: bool = True,
    infer_schema: bool = True,
) -> DataFrame:
    """CSV scan. With a ``schema`` nothing is inferred (no extra pass over the files); without
    one, ``infer_schema`` decides between inferred types and all-string columns. Inference
    reads the whole input once more; on very large feeds pass a ``schema``."""
    reader = spark.read.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", str(infer_schema).lower())
    return reader.csv(path)


def normalized_name(name: str) -> str:
    """Header → column name: spaces become ``_``, parentheses are removed, lower case."""
    return re.sub(r"[()]", "", name.replace(" ", "_")).lower()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with ``normalized_name`` in one projection. Two headers that map to
    the same name are an error rather than a silently ambiguous column."""
    names = [normalized_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    clashes = []
    for old, new in zip(df.columns, names):
        if new in seen:
            clashes.append(f"{seen[new]!r} and {old!r} -> {new!r}")
        seen.setdefault(new, old)
    if clashes:
        raise ValueError("column names collide after normalisation: " + "; ".join(clashes))
    return df.toDF(*names)


def write_copy(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """The complete copy at ``path``, made by ``write(folder)`` unless there is one. A folder that
    holds anything but copies was not written here: that is an error, and it is left alone."""
    path = path.rstrip("/")
    done = complete_copy(spark, path)
    if done:
        return done
    if any(not name.startswith(COPY_PREFIX) for name in list_names(spark, path)):
        raise FileExistsError(f"{path} exists without _SUCCESS; it was not written here and is left alone")
    own = f"{path}/{COPY_PREFIX}{uuid.uuid4().hex}"
    write(own)
    if not has_marker(spark, own):
        raise OSError(f"{own} has no _SUCCESS marker: the committer must write it")
    done = complete_copy(spark, path)
    if done != own:
        delete_folder(spark, own)  # a rival was complete before; nobody reads this one
    return done


def materialize(df: DataFrame, path: str, partition_by=None, row_group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` unless a complete copy is there, then return the
    Parquet scan, so the first and later runs share one lineage (and the Parquet file's
    pushdown and pruning). A folder there that holds something else is an error.

    ``row_group_bytes`` caps the Parquet row group size: a reader splits a file only at row
    group boundaries, so a small table written by one task still scans on many cores."""

    def write(folder: str) -> None:
        writer = df.write
        if row_group_bytes:
            writer = writer.option("parquet.block.size", int(row_group_bytes))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)

    return df.sparkSession.read.parquet(write_copy(df.sparkSession, path, write))


def materialize_parquet(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    normalize: bool = False,
    schema=None,
    infer_schema: bool = True,
) -> DataFrame:
    """CSV → Parquet once under ``<out_dir>/parquet``; every call returns the Parquet scan.
    With ``normalize`` the headers are normalised before the copy is written. With a ``schema``
    (of the CSV's own columns) the feed is read once; inference reads it once more."""
    target = out_dir.rstrip("/") + "/parquet"
    done = complete_copy(spark, target)
    if done:
        return spark.read.parquet(done)
    df = read_csv(spark, csv_path, schema=schema, infer_schema=infer_schema)
    if normalize:
        df = normalize_columns(df)
    return materialize(df, target)


def load_tables(
    spark: SparkSession, directory: str, suffix: str = ".csv", register_views: bool = False
) -> dict[str, DataFrame]:
    """Every ``*.csv`` entry of ``directory`` (file or Spark-written folder) as an all-string
    table keyed by its stem, each copied once to ``<directory>/parquet/<stem>`` and returned
    as the Parquet scan; copies are found without their CSV. With ``register_views`` each table is also a temp view named by its
    stem, for SQL text."""
    base = directory.rstrip("/")
    tables = {}
    for stem in list_names(spark, f"{base}/parquet"):  # copies whose CSV may be gone
        done = complete_copy(spark, f"{base}/parquet/{stem}")
        if done:
            tables[stem] = spark.read.parquet(done)
    for name in list_names(spark, base):
        if not name.endswith(suffix):
            continue
        stem = name[: -len(suffix)]
        target = f"{base}/parquet/{stem}"
        if stem not in tables:
            tables[stem] = materialize(read_csv(spark, f"{base}/{name}", infer_schema=False), target)
    if register_views:
        for stem, df in tables.items():
            df.createOrReplaceTempView(stem)
    return tables


__all__ = [
    "complete_copy",
    "content_bytes",
    "delete_folder",
    "has_marker",
    "is_complete",
    "list_names",
    "load_tables",
    "materialize",
    "materialize_parquet",
    "normalize_columns",
    "normalized_name",
    "path_exists",
    "read_csv",
    "write_copy",
]
