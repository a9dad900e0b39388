"""Hot keys: one country (and one text) holds a third of all rows. Results must be whole and
equal to brute-force window formulations; plans must keep pre-aggregation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import balance_by_period, duplicate_keys, leader_in_group, period_totals, top_with_ties
from tallyspark.session import cluster_conf
from tests.helpers import plan_text, rows


def skewed_trade(spark, n=3000):
    # a third of the rows belong to country HOT; measures repeat so ties occur
    return (
        spark.range(n)
        .select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 17).cast("string"))).alias("country_or_area"),
            (F.lit(1995) + F.col("id") % 5).cast("int").alias("year"),
            (F.col("id") % 40).cast("string").alias("comm_code"),
            F.concat(F.lit("item"), (F.col("id") % 40).cast("string")).alias("commodity"),
            F.concat(F.lit("cat"), (F.col("id") % 4).cast("string")).alias("category"),
            F.when(F.col("id") % 2 == 0, F.lit("Export")).otherwise(F.lit("Import")).alias("flow"),
            ((F.col("id") * 7919) % 1000).cast("long").alias("trade_usd"),
        )
        .repartition(6)
    )


def test_top_with_ties_under_skew(spark):
    t = skewed_trade(spark)
    w = Window.partitionBy("country_or_area", "flow")
    ref = t.withColumn("mx", F.max("trade_usd").over(w)).filter("mx = trade_usd").drop("mx")
    got = top_with_ties(t, label=False).drop("biggest_trade")
    assert rows(ref) == rows(got)
    assert any(r[0] == "HOT" for r in rows(got))


def test_leader_and_period_totals_under_skew(spark):
    t = skewed_trade(spark)
    per = t.groupBy("commodity", "category", "flow").agg(F.sum("trade_usd").alias("s"))
    top = per.withColumn("m", F.max("s").over(Window.partitionBy("category", "flow"))).filter("m = s")
    got = leader_in_group(t, label=False)
    assert sorted((r.commodity, r.category, r.flow, r.s) for r in top.collect()) == sorted(
        (r.commodity, r.category, r.flow, r.sum_for_good) for r in got.collect()
    )
    totals = period_totals(t)
    hot = [r for r in totals.collect() if r.country_or_area == "HOT"]
    expected = t.filter("country_or_area = 'HOT'").groupBy("flow", "year").agg(F.sum("trade_usd").alias("s"))
    assert sorted((r.flow, r.year, r.overall_sum) for r in hot) == sorted((r.flow, r.year, r.s) for r in expected.collect())
    assert "partial_sum" in plan_text(totals)


def test_balance_by_period_under_skew(spark):
    t = skewed_trade(spark)
    per = t.groupBy("country_or_area", "flow", "year").agg(F.sum("trade_usd").alias("export_total"))
    w = Window.partitionBy("country_or_area", "year").orderBy("flow")
    ref = (
        per.withColumn("import_total", F.lead("export_total", 1).over(w))
        .withColumn("saldo", F.col("export_total") - F.col("import_total"))
        .filter("saldo is not null")
        .select("country_or_area", "year", "export_total", "import_total", "saldo")
    )
    got = balance_by_period(t).select("country_or_area", "year", "export_total", "import_total", "saldo")
    assert rows(ref) == rows(got)


def test_hot_duplicate_text(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("the same long text " * 20)).otherwise(F.concat(F.lit("doc "), F.col("id").cast("string"))).alias("text")
    )
    got = rows(duplicate_keys(docs, "text"))
    assert got == [("the same long text " * 20, 1000)]


def test_cluster_conf_sizes_partitions():
    conf = cluster_conf(largest_shuffle_bytes=40e12, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) >= 40e12 / (256 * 1024 * 1024)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(largest_shuffle_bytes=1e9, total_cores=100)
    assert int(small["spark.sql.shuffle.partitions"]) == 300


def test_queries_under_cluster_settings(spark):
    """The recommended cluster settings (SQL ones, scaled down) work with the operators,
    including the RocksDB state store for the stream."""
    import tempfile

    from tallyspark.plans import registry
    from tallyspark.streaming import run_complete, running_totals, snapshot_batch, snapshot_stream
    from tests.helpers import SF0001, SF001

    conf = cluster_conf(largest_shuffle_bytes=64 * 1024 * 1024, total_cores=4, partition_bytes=8 * 1024 * 1024)
    applied = {}
    for key, value in conf.items():
        if not key.startswith("spark.sql."):
            continue  # deployment settings (decommissioning) are fixed at application start
        applied[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        q = registry.queries()
        expected = {n: rows(q[n](spark, SF001)) for n in ("balance", "leader_in_group", "loan_share")}
        assert all(expected.values())
        base = tempfile.mkdtemp(prefix="tallyspark-cluster-")
        path = registry.snapshot_files(spark, SF0001)
        streamed = run_complete(running_totals(snapshot_stream(spark, path), sort=False), base + "/out", base + "/ckpt")
        batch = running_totals(snapshot_batch(spark, path), sort=False)
        r = lambda df: df.select("name", F.round("total_memory_percent", 6))
        assert rows(r(streamed)) == rows(r(batch))
    finally:
        for key, old in applied.items():
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)
    # same answers as under the local settings
    assert {n: rows(registry.queries()[n](spark, SF001)) for n in expected} == expected
