"""Structured Streaming operators over snapshot files."""

from tallyspark.streaming.snapshots import (
    EPOCH_PATTERN,
    MAX_AGE_SECONDS,
    SNAPSHOT_SCHEMA,
    by_total,
    fresh_snapshots,
    latest_per_key,
    read_totals,
    read_version,
    run_append,
    run_complete,
    run_update,
    running_totals,
    snapshot_batch,
    snapshot_stream,
    start_totals,
    totals_of,
    with_snapshot_epoch,
    write_snapshot_files,
)

__all__ = [
    "EPOCH_PATTERN",
    "MAX_AGE_SECONDS",
    "SNAPSHOT_SCHEMA",
    "by_total",
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
