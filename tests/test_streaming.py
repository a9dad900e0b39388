import os
import tempfile

from tests.helpers import SF0001, rows
from pyspark.sql import functions as F

from tallyspark.plans.registry import FRESH_AS_OF_EPOCH, snapshot_files
from tallyspark.streaming import (
    fresh_snapshots,
    run_append,
    run_complete,
    running_totals,
    snapshot_batch,
    snapshot_stream,
)


def _dirs():
    base = tempfile.mkdtemp(prefix="tallyspark-stream-")
    return base + "/out", base + "/ckpt"


def test_stream_totals_equal_batch_totals(spark):
    path = snapshot_files(spark, SF0001)
    out, ckpt = _dirs()
    measures = ("memory_percent", "cpu_percent")
    streamed = run_complete(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1), measures=measures), out, ckpt)
    batch = running_totals(snapshot_batch(spark, path), measures=measures)
    r4 = lambda df: df.select("name", *[F.round(f"total_{m}", 6).alias(m) for m in measures])
    assert rows(r4(streamed)) == rows(r4(batch))


def test_stream_restart_resumes_from_checkpoint(spark):
    path = snapshot_files(spark, SF0001)
    out, ckpt = _dirs()
    first = rows(run_complete(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1)), out, ckpt))
    # a second run with the same checkpoint sees no new files and leaves the result as is
    second = rows(run_complete(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1)), out, ckpt))
    assert first == second


def test_fresh_snapshots_boundary(spark):
    df = spark.createDataFrame([(1, 1000), (2, 700), (3, 699), (4, 2000)], "id int, snapshot_epoch long")
    assert [r.id for r in fresh_snapshots(df, 1000).orderBy("id").collect()] == [1, 2, 4]


def test_fresh_snapshots_stream_keeps_last_snapshot_only(spark):
    path = snapshot_files(spark, SF0001)
    out, ckpt = _dirs()
    fresh = run_append(fresh_snapshots(snapshot_stream(spark, path, max_files_per_trigger=1), FRESH_AS_OF_EPOCH), out, ckpt)
    epochs = {r.snapshot_epoch for r in fresh.select("snapshot_epoch").distinct().collect()}
    assert epochs == {FRESH_AS_OF_EPOCH - 300}
    all_epochs = {r.snapshot_epoch for r in snapshot_batch(spark, path).select("snapshot_epoch").distinct().collect()}
    assert len(all_epochs) == 5


def test_fresh_snapshots_wall_clock(spark):
    import time

    now = int(time.time())
    df = spark.createDataFrame([(1, now - 10), (2, now - 10_000)], "id int, snapshot_epoch long")
    assert [r.id for r in fresh_snapshots(df, None).collect()] == [1]


def test_clean_source_archives_consumed_files(spark):
    import os
    import shutil

    base = tempfile.mkdtemp(prefix="tallyspark-clean-")
    src = snapshot_files(spark, SF0001).rsplit("/sys_log=", 1)[0]
    shutil.copytree(src, base + "/in")
    out, ckpt = _dirs()
    stream = snapshot_stream(spark, base + "/in/sys_log=*/*.csv", max_files_per_trigger=1, clean_source="archive", archive_dir=base + "/archive")
    got = run_append(stream, out, ckpt)
    assert got.count() == 1000
    archived = [f for _, _, fs in os.walk(base + "/archive") for f in fs if f.endswith(".csv")]
    assert len(archived) >= 1


def test_update_mode_equals_complete_mode(spark):
    from tallyspark.streaming import run_update

    path = snapshot_files(spark, SF0001)
    out_c, ck_c = _dirs()
    out_u, ck_u = _dirs()
    complete = run_complete(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1), sort=False), out_c, ck_c)
    update = run_update(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1), sort=False), out_u, ck_u)
    r = lambda df: df.select("name", F.round("total_memory_percent", 6))
    assert rows(r(update)) == rows(r(complete))
    # the update log holds one row per changed key per batch, not the whole state per batch
    log = spark.read.parquet(out_u)
    assert log.select("batch_id").distinct().count() == 5


def test_latest_per_key_absorbs_retried_batches(spark):
    from tallyspark.streaming import latest_per_key

    log = spark.createDataFrame(
        [("a", 1.0, 0), ("a", 3.0, 1), ("a", 3.0, 1), ("b", 2.0, 0)], "name string, total double, batch_id long"
    )
    assert rows(latest_per_key(log)) == [("a", 3.0), ("b", 2.0)]


def test_stream_state_stores_are_bounded(spark, monkeypatch):
    from tallyspark.streaming import snapshots

    key = "spark.sql.shuffle.partitions"
    was = spark.conf.get(key)
    monkeypatch.setattr(snapshots.few_state_stores.__wrapped__, "__defaults__", (3,))
    out, ckpt = _dirs()
    run_complete(running_totals(snapshot_stream(spark, snapshot_files(spark, SF0001)), sort=False), out, ckpt)
    stores = [d for d in os.listdir(ckpt + "/state/0") if d.isdigit()]
    assert len(stores) == 3 and spark.conf.get(key) == was
