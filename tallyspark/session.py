"""Session helpers: the shared scratch folder and the configuration used by tests and the bench.

Operators never create sessions; they take and return DataFrames. Only the entry points
(tests, ``bench.py``) build one, and everything that must be written (fixture tables, CSV
round trips, stream checkpoints) goes under the folder the cluster names in
``spark.checkpoint.dir``, which every executor can reach.
"""

from __future__ import annotations

import math
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
PACKAGE_DIR = "tallyspark"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session. Only when it is unset on a local master (a laptop or a unit test)
    is a fresh local folder created and registered as the checkpoint directory; on a cluster
    that would scatter the parts of a table over the executors' own disks, so it is an error.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{CHECKPOINT_KEY} is not set: name a folder that all executors share (master {master})")
        root = tempfile.mkdtemp(prefix="tallyspark-checkpoint-")
        spark.sparkContext.setCheckpointDir(root)
        try:
            spark.conf.set(CHECKPOINT_KEY, root)
        except Exception:  # static conf on some deployments; setCheckpointDir is enough
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder, namespaced by this package."""
    return "/".join([shared_root(spark), PACKAGE_DIR, *parts])


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tallyspark",
    driver_memory: str = "8g",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is used instead.

    AQE stays on: it coalesces small shuffle partitions, converts joins to broadcast only
    when a materialised side is measured under the threshold, and splits skewed join
    partitions.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def cluster_conf(
    largest_shuffle_bytes: float = 40e12,
    total_cores: int = 8000,
    partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Settings for a large cluster (e.g. 1 000 executors over ~100 TB of Parquet).

    Shuffle partitions start at ``largest_shuffle_bytes / partition_bytes`` (at least three
    waves of ``total_cores``), and AQE coalesces them down to ``partition_bytes`` per task, so
    the largest shuffle fits executor memory without spilling and small ones do not run
    thousands of empty tasks. Skewed join partitions are split at run time, and broadcasts
    stay within 64 MB. Executors that are being decommissioned hand their shuffle files off.
    """
    partitions = max(3 * total_cores, math.ceil(largest_shuffle_bytes / partition_bytes))
    mb = f"{partition_bytes // (1024 * 1024)}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
