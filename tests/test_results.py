"""Versions and logs of stream results under failures, retries and many batches; file copies
without rename; owned scratch folders."""

import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from tallyspark.plans import jobs, registry
from tallyspark.scratch import Scratch, new_folder
from tallyspark.session import scratch_path
from tallyspark.sources import files
from tallyspark.streaming import run_complete, run_update, running_totals, snapshot_batch, snapshot_stream, totals_of
from tallyspark.streaming import results
from tests.helpers import SF001, SF0001, rows


def _dir():
    return tempfile.mkdtemp(prefix="tallyspark-results-")


class Broken(Exception):
    pass


def test_a_batch_that_fails_halfway_leaves_the_last_result(spark, monkeypatch):
    out = _dir() + "/out"
    results.write_version(spark.range(3), out, 0)
    half = spark.range(1000).select(F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        results.write_version(half, out, 1)
    assert rows(results.read_version(spark, out)) == [(0,), (1,), (2,)]
    results.write_version(spark.range(5), out, 1)  # the batch is run again
    assert results.read_version(spark, out).count() == 5
    for n in range(2, 8):
        results.write_version(spark.range(n), out, n)
    assert sorted(files.list_names(spark, out)) == ["version=6", "version=7"]
    with pytest.raises(FileNotFoundError):
        results.read_version(spark, out + "-none")


def test_a_stream_publishes_versions(spark):
    path, base = registry.snapshot_files(spark, SF0001), _dir()
    got = run_complete(running_totals(snapshot_stream(spark, path, max_files_per_trigger=1)), base + "/out", base + "/ckpt")
    whole = running_totals(snapshot_batch(spark, path))
    assert rows(got) == rows(whole)  # bit for bit, though batches came one by one
    assert len(files.list_names(spark, base + "/out")) == results.KEPT_VERSIONS


def changes(spark, batch_id, keys=10):
    """Every batch changes three keys."""
    return spark.createDataFrame([(f"k{(batch_id + i) % keys}", float(batch_id)) for i in range(3)], "name string, total double")


def test_logs_stay_bounded_over_a_thousand_batches(spark, monkeypatch):
    out, keys = _dir() + "/out", 10
    newest = {}
    # the writes of single batches are left to one job per 50 of them: what is tested is the log
    for start in range(0, 1000, 50):
        for n in range(start, start + 50):
            folder = f"{out}/batch_id={n}/copy-x"
            os.makedirs(folder)
            newest |= {f"k{(n + i) % keys}": float(n) for i in range(3)}
        rows_of = [(n, f"k{(n + i) % keys}", float(n)) for n in range(start, start + 50) for i in range(3)]
        staged = spark.createDataFrame(rows_of, "batch_id long, name string, total double").repartition(1)
        target = _dir() + "/all"
        staged.write.partitionBy("batch_id").parquet(target)
        for n in range(start, start + 50):
            part = f"{target}/batch_id={n}"
            for f in os.listdir(part):
                os.link(f"{part}/{f}", f"{out}/batch_id={n}/copy-x/{f}")
            open(f"{out}/batch_id={n}/copy-x/_SUCCESS", "w").close()
        results.compact(spark, out, start + 49, "name")
        assert len(files.list_names(spark, out)) <= 100 and len(files.list_names(spark, out + "-base")) <= 2
    assert {r.name: r.total for r in results.read_changes(spark, out, "name").collect()} == newest
    assert spark.read.parquet(files.complete_copy(spark, f"{out}-base/through=999")).count() == keys


def test_retried_batches_around_a_compaction(spark):
    out = _dir() + "/out"
    for n in range(6):
        results.write_changes(changes(spark, n), out, n, "name", compact_every=3)
    expected = rows(results.read_changes(spark, out, "name"))
    results.write_changes(changes(spark, 2), out, 2, "name", compact_every=3)  # covered by the base
    results.write_changes(changes(spark, 5), out, 5, "name", compact_every=3)  # compacted again
    assert rows(results.read_changes(spark, out, "name")) == expected
    results.write_changes(changes(spark, 6), out, 6, "name", compact_every=3)
    assert dict(rows(results.read_changes(spark, out, "name")))["k6"] == 6.0


def test_a_compaction_that_fails_leaves_the_log(spark, monkeypatch):
    out = _dir() + "/out"
    for n in range(3):
        results.write_changes(changes(spark, n), out, n, "name", compact_every=0)
    expected = rows(results.read_changes(spark, out, "name"))

    def fail(*a):
        raise Broken

    monkeypatch.setattr(results, "write_copy", fail)
    with pytest.raises(Broken):
        results.compact(spark, out, 2, "name")
    monkeypatch.undo()
    assert rows(results.read_changes(spark, out, "name")) == expected
    results.compact(spark, out, 2, "name")
    assert rows(results.read_changes(spark, out, "name")) == expected


def test_update_mode_with_compaction(spark):
    path, base = registry.snapshot_files(spark, SF0001), _dir()
    stream = running_totals(snapshot_stream(spark, path, max_files_per_trigger=1), sort=False)
    got = run_update(stream, base + "/out", base + "/ckpt", compact_every=2)
    assert rows(got) == rows(totals_of(running_totals(snapshot_batch(spark, path), sort=False)))
    assert files.list_names(spark, base + "/out-base")


def test_monitor_modes(spark, capsys):
    path, base = registry.snapshot_files(spark, SF0001), _dir()
    whole = rows(running_totals(snapshot_batch(spark, path)))
    update = jobs.process_monitor(spark, path, base + "/u", base + "/uc", processing_time=None, mode="update", max_files_per_trigger=2)
    update.awaitTermination()
    from tallyspark.streaming import read_totals

    keys = ["name", "total_memory_percent__bin"]
    assert rows(read_totals(spark, base + "/u", keys)) == whole
    jobs.process_monitor(spark, path, None, base + "/cc", processing_time=None, mode="console").awaitTermination()
    assert "total_memory_percent" in capsys.readouterr().out
    old = jobs.process_monitor(spark, path, base + "/o", base + "/oc", processing_time=None, max_age_seconds=60)
    old.awaitTermination()  # all snapshots are years old
    with pytest.raises(ValueError):
        jobs.process_monitor(spark, path, base, base, mode="append")


# ---------------------------------------------------------------- copies
def test_an_interrupted_copy_is_not_read(spark):
    path = _dir() + "/copy"
    half = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        files.materialize(half, path)
    assert not files.is_complete(spark, path)
    os.makedirs(path + "/copy-0/_temporary")  # what a killed writer leaves
    assert files.materialize(spark.range(7), path).count() == 7
    assert files.materialize(spark.range(9), path).count() == 7


def test_rival_writers_agree(spark):
    path, got = _dir() + "/copy", []
    gate = threading.Barrier(3)

    def write(n):
        def slowly(folder):
            gate.wait(60)  # all have found nothing before any writes
            spark.range(n).write.parquet(folder)

        got.append(files.write_copy(spark, path, slowly))

    threads = [threading.Thread(target=write, args=(n,)) for n in (5, 6, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winner = files.complete_copy(spark, path)
    # each has a complete copy; later readers all take the first
    assert winner in got and all(files.has_marker(spark, g) for g in got)
    assert spark.read.parquet(winner).count() in (5, 6, 7)


def test_nothing_is_renamed():
    with open(files.__file__) as f:
        assert "fs.rename" not in f.read()


# ---------------------------------------------------------------- scratch
def folders(spark, kind):
    return set(files.list_names(spark, scratch_path(spark, kind)))


def test_queries_leave_no_folders(spark):
    q = registry.queries()
    before = {kind: folders(spark, kind) for kind in ("stages", "runs")}
    for name in ("top_with_ties", "daily_basket", "attach_daily_map", "peer_mean", "period_comparison", "duplicate_texts_prefiltered", "running_totals", "running_totals_update", "fresh_snapshots", "materialize_parquet"):
        with Scratch(spark):
            assert q[name](spark, SF0001).collect() is not None
        assert {kind: folders(spark, kind) for kind in ("stages", "runs")} == before, name


def test_owners_nest_and_close(spark):
    with Scratch(spark) as outer:
        kept = new_folder(spark, "stages", "kept")
        spark.range(1).write.parquet(kept)
        with Scratch(spark):
            gone = new_folder(spark, "stages", "gone")
            spark.range(1).write.parquet(gone)
        assert not files.path_exists(spark, gone) and files.path_exists(spark, kept)
        assert outer.folders == [kept]
    assert not files.path_exists(spark, kept)


def test_reports_build_shared_frames_once(spark, monkeypatch):
    from tallyspark.plans.fixtures import fixture

    base = _dir()
    for stem, name in (("FACT_CRYPTO_RATE", "crypto_rate"), ("DIM_CRYPTO_DATA", "crypto_dim"), ("FACT_GPU_PRICE", "gpu_price"), ("DIM_GPU_PROD", "gpu_dim"), ("DIM_TIME", "time_dim")):
        fixture(spark, SF0001, name).write.option("header", "true").csv(f"{base}/{stem}.csv")
    built = []
    real = jobs.daily_basket
    monkeypatch.setattr(jobs, "daily_basket", lambda *a, **k: built.append(1) or real(*a, **k))
    before = folders(spark, "stages")
    with jobs.market_reports(spark, base, registry.MANUFACTURER) as reports:
        assert not built and len(reports) == 5
        for name in reports:
            assert reports[name].count() >= 0
        assert len(built) == 1 and folders(spark, "stages") != before
    assert folders(spark, "stages") == before


def test_a_job_with_a_schema_reads_its_feed_once(spark):
    from tallyspark.plans.fixtures import fixture

    base = _dir()
    trade = fixture(spark, SF001, "trade").limit(500)
    trade.write.option("header", "true").csv(base + "/trade.csv")
    with jobs.trade_reports(spark, base + "/trade.csv", base + "/out", since=1998, schema=trade.schema) as reports:
        assert reports["clean_rows"].schema == trade.schema
        assert set(reports._built) == {"clean_rows"}
