"""The generated Parquet tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


# Scans of the read-only generated tables, per Spark application: building a Parquet scan
# lists the files and reads the footer on the driver, so each table is opened once.
_SCANS: dict[tuple[str, str], DataFrame] = {}


def memo_scan(spark: SparkSession, key: str, build) -> DataFrame:
    """The DataFrame for ``key`` built once per Spark application (lazy plans only; nothing
    is cached in memory and every action still reads the files)."""
    k = (spark.sparkContext.applicationId, key)
    if k not in _SCANS:
        _SCANS[k] = build()
    return _SCANS[k]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = table_path(sf_dir, name)
    return memo_scan(spark, path, lambda: spark.read.parquet(path))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views over the Parquet tables, for SQL text that names them."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
