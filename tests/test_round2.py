"""Cases that earlier versions got wrong."""

import math

import pytest
from pyspark.sql import functions as F

from tallyspark import session
from tallyspark.functions import exact_totals
from tallyspark.operators.joins import size_probe
from tallyspark.operators.quality import duplicate_keys
from tallyspark.streaming import snapshots


def test_duplicates_of_collated_text_and_refused_prefilter(spark):
    df = spark.createDataFrame([("A",), ("a",), ("b",)], "c string").select(F.collate("c", "UTF8_LCASE").alias("c"))
    assert [r.number_of_occurrences for r in duplicate_keys(df, "c").collect()] == [2]
    with pytest.raises(ValueError):
        duplicate_keys(df, "c", hash_prefilter=True)


@pytest.mark.parametrize("values", [[4e-11, 3e-11], [1e29, 1.0], [0.1, 0.2, None], [float("inf"), 1.0], [1e27] * 20])
def test_sums_keep_small_and_large_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_totals(df, [], sums={"s": "v"}, means={"m": "v"}).first()
    held = [v for v in values if v is not None]
    assert math.isclose(got.s, sum(held), rel_tol=1e-12) and math.isclose(got.m, sum(held) / len(held), rel_tol=1e-12)


def test_epochs_keep_their_fraction_and_come_from_the_file(spark, tmp_path):
    folder = tmp_path / "sys_log1"
    folder.mkdir()
    for name in ("sys_log1000.9.csv", "sys_log1704067200.csv"):
        (folder / name).write_text("1,a,1.0,2.0\n")
    df = snapshots.snapshot_batch(spark, str(folder))
    assert sorted(r.snapshot_epoch for r in df.collect()) == [1000.9, 1704067200.0]
    assert snapshots.fresh_snapshots(df, 1300.5).where("snapshot_epoch < 2000").count() == 1


def test_nested_values_are_measured(spark):
    df = spark.range(10).select(F.array_repeat(F.rand(), 5000).alias("a"))
    assert df.agg(*size_probe(df)).first()["bytes"] > 10 * 5000 * 8


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(Session())
