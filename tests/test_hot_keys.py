"""Joins and duplicate checks past the broadcast bound with a third of the rows on one key, and the
shuffles of the daily price reports."""

import re

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import DailyPrices, attach_daily_map, duplicate_keys, enrich_facts, join_dimension, peer_mean
from tallyspark.operators import market
from tallyspark.operators.joins import _frequent_keys
from tallyspark.operators.quality import may_be_among
from tallyspark.plans import registry
from tallyspark.plans.fixtures import typed_fixture
from tests.helpers import SF001, SF0001, plan_text, rows


@pytest.fixture()
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def skewed(spark, n=30_000):
    """A third of the facts have the key 0, a tenth none; the others spread over 500 keys."""
    key = F.when(F.col("id") % 3 == 0, F.lit("0")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    return spark.range(0, n, 1, 8).select(key.alias("k"), F.col("id").alias("v"))


def most_over_median(df):
    """Rows of the largest result partition over those of the median one."""
    counts = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    return counts[-1] / counts[len(counts) // 2]


def test_a_hot_key_stays_out_of_the_shuffle(spark, no_broadcast):
    facts = skewed(spark)
    dim = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("w"))
    joined = join_dimension(facts, dim, "k", "id", max_rows=10)
    plain = facts.join(dim, facts.k == dim.id).select("k", "v", "w")
    assert rows(joined.select("k", "v", "w")) == rows(plain)
    assert most_over_median(joined) < 3 < most_over_median(plain)
    assert "CartesianProduct" not in plan_text(joined) and "BroadcastNestedLoopJoin" not in plan_text(joined)
    # a dimension that repeats the hot key, and clashing names
    twice = dim.unionByName(dim.where("id = '0'")).withColumnRenamed("w", "v2")
    assert join_dimension(facts, twice, "k", "id", max_rows=10).where("k = '0'").count() == 2 * facts.where("k = '0'").count()
    assert join_dimension(facts.where("false"), dim, "k", "id", max_rows=10).count() == 0


def test_facts_without_a_hot_key_are_shuffled_once(spark, no_broadcast):
    facts = spark.range(0, 30_000, 1, 8).select((F.col("id") % 3000).cast("string").alias("k"), F.col("id").alias("v"))
    dim = spark.range(2000).select(F.col("id").cast("string").alias("id"), (F.col("id") * 2).alias("w"))
    joined = join_dimension(facts, dim, "k", "id", max_rows=10)
    assert rows(joined.select("k", "v", "w")) == rows(facts.join(dim, facts.k == dim.id).select("k", "v", "w"))
    assert plan_text(joined).count("(1) Range") <= 2 and "Union" not in plan_text(joined)  # listed in the tree and below it
    keys = _frequent_keys(skewed(spark), "k", 1000)
    assert "0" in {r[0] for r in keys.collect()} and "Exchange hashpartitioning" not in plan_text(keys)
    # keys that the sketch does not take, and equal rows
    binary = skewed(spark).select(F.encode("k", "UTF-8").alias("k"), (F.col("v") % 2).alias("v"))
    theirs = dim.select(F.encode("id", "UTF-8").alias("id"), "w")
    once = join_dimension(binary, theirs, "k", "id", max_rows=10, distinct=True)
    assert rows(once.select("k", "v", "w")) == rows(binary.join(theirs, binary.k == theirs.id).select("k", "v", "w").distinct())


def test_many_products_meet_prices_in_one_shuffle(spark, no_broadcast):
    prices, products = typed_fixture(spark, SF001, "gpu_price"), typed_fixture(spark, SF001, "gpu_dim")
    basket = registry.basket(spark, SF001, sort=False)
    few = DailyPrices.of(prices.unionByName(prices.limit(50)), products, basket).attached()
    # each product as five, so that none has a thousandth of the prices
    spread = prices.withColumn("ProdId", F.concat("ProdId", F.lit("-"), F.pmod(F.hash("Price_USD"), F.lit(5)).cast("string")))
    wide = products.crossJoin(spark.range(5).select(F.col("id").alias("__n"))).withColumn("Id", F.concat("Id", F.lit("-"), F.col("__n").cast("string"))).drop("__n")
    many = DailyPrices.of(spread.unionByName(spread.limit(50)), wide, basket, max_products=1).attached()
    plan = plan_text(many)
    got = many.withColumn("ProdId", F.substring_index("ProdId", "-", 1))
    assert rows(got.select(*few.columns)) == rows(few)
    order = [(r.ProdId, r.TimeId) for r in many.collect()]
    assert order == sorted(order)
    shuffles = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: (\w+)partitioning", plan)
    on_prices = [(columns, kind) for columns, kind in shuffles if "Price_USD" in columns]
    assert [kind for _, kind in on_prices] == ["hash", "range"]  # by product, then the order
    assert not any("Coin_Map" in columns for columns, _ in on_prices)


def test_prices_of_a_hot_product_past_the_bound(spark, no_broadcast):
    prices, products = typed_fixture(spark, SF0001, "gpu_price"), typed_fixture(spark, SF0001, "gpu_dim")
    hot = products.where("Memory_Capacity >= 2").first().Id
    ids = [r.Id for r in products.collect()]
    third = F.when(F.col("MerchantId").cast("int") % 3 == 0, F.lit(hot)).otherwise(F.element_at(F.lit(ids), (F.abs(F.hash("MerchantId", "TimeId", "Price_USD")) % len(ids) + 1).cast("int")))
    prices = prices.withColumn("ProdId", third).repartition(8)
    assert rows(enrich_facts(prices, products, max_rows=1)) == rows(enrich_facts(prices, products))
    basket = registry.basket(spark, SF0001, sort=False)
    few = DailyPrices.of(prices, products, basket)
    many = DailyPrices.of(prices, products, basket, max_products=1, max_days=1)
    assert rows(many.attached().select(*few.attached().columns)) == rows(few.attached())
    assert rows(many.peer_mean("Brand#1").select(*few.peer_mean("Brand#1").columns)) == rows(few.peer_mean("Brand#1"))


def test_daily_prices_equal_the_wide_forms(spark):
    prices, products = typed_fixture(spark, SF0001, "gpu_price"), typed_fixture(spark, SF0001, "gpu_dim")
    products = products.unionByName(products)  # equal product rows count once
    prices = prices.unionByName(prices.limit(50))
    basket = registry.basket(spark, SF0001, sort=False)
    daily = DailyPrices.of(prices, products, basket)
    wide = attach_daily_map(enrich_facts(prices, products), basket)
    got = daily.attached()
    assert rows(got.select(*wide.columns)) == rows(wide)
    order = [(r.ProdId, r.TimeId) for r in got.collect()]
    assert order == sorted(order)
    means = peer_mean(wide, "Brand#1")
    assert rows(daily.peer_mean("Brand#1").select(*means.columns)) == rows(means)


def test_price_shuffles_carry_price_columns_only(spark):
    plan = plan_text(registry.daily_prices(spark, SF0001).attached())
    shuffles = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: (\w+)partitioning", plan)
    on_prices = [(columns, kind) for columns, kind in shuffles if "Price_USD" in columns]
    assert [kind for _, kind in on_prices] == ["hash", "range"]  # de-duplication, then the order
    assert not any(re.search("Processor|Coin_Map", columns) for columns, _ in on_prices)
    unsorted = plan_text(registry.daily_prices(spark, SF0001).attached(sort=False))
    assert len(re.findall(r"Exchange\nInput \[6\][^\n]*Price_USD", unsorted)) == 1


def test_many_rates_of_a_coin_make_one_entry(spark):
    rates = spark.range(200_000).select(
        F.lit("d").alias("TimeId"), (F.col("id") % 1000).cast("double").alias("High"), F.lit("ONE").alias("Currency_Name"),
        F.lit(7).cast("long").alias("Number_Of_Mineable_Coins"), F.lit(1.5).alias("Avg_Crypto_Rate"),
    )
    more = spark.createDataFrame([("d", 1.0, "TWO", 7, 1.5), ("d", 3.0, None, 7, 1.5), ("d", None, "THREE", 7, 1.5)], "TimeId string, High double, Currency_Name string, Number_Of_Mineable_Coins long, Avg_Crypto_Rate double")
    prices = spark.createDataFrame([("p", "d")], "ProdId string, TimeId string")
    got = attach_daily_map(prices, rates.unionByName(more)).first()
    assert got.Coin_Map == '[{"ONE":999.0},{"THREE":null},{"TWO":1.0}]'


def test_duplicates_of_a_hot_text(spark, no_broadcast):
    texts = skewed(spark).select(F.when(F.col("k") == "0", F.lit("hot " * 50)).otherwise(F.concat(F.lit("t"), F.col("v").cast("string"))).alias("t"))
    texts = texts.unionByName(texts.limit(40)).unionByName(spark.createDataFrame([(None,), (None,)], "t string"))
    expected = rows(duplicate_keys(texts, "t"))
    assert rows(duplicate_keys(texts, "t", hash_prefilter=True)) == expected
    # forced collisions: of fingerprints, and of the filter's bits
    assert rows(duplicate_keys(texts, "t", hash_prefilter=True, fingerprints=(F.lit(1).cast("long"), F.lit(2)))) == expected
    assert rows(duplicate_keys(texts, "t", hash_prefilter=True, filter_bits=8)) == expected
    assert rows(duplicate_keys(texts.where("false"), "t", hash_prefilter=True)) == []


def test_the_filter_drops_single_keys_where_they_lie(spark):
    keys = spark.range(40_000).select(F.xxhash64("id").alias("f"))
    members = keys.where("f % 50 = 0")
    kept = may_be_among(keys, "f", members, 1 << 20)
    assert members.exceptAll(kept).isEmpty() and kept.count() < members.count() * 1.2
    plan = plan_text(kept)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_one_makers_many_products_leave_other_prices_where_they_lie(spark, no_broadcast):
    products = spark.range(400).select(
        F.col("id").cast("string").alias("Id"),
        F.when(F.col("id") % 20 == 0, "NV").otherwise("AMD").alias("Processor_Manufacturer"),
        F.concat(F.lit("p"), F.col("id")).alias("Processor"),
        F.lit("g").alias("GPU_Manufacturer"),
        F.when(F.col("id") % 40 == 0, 1.0).otherwise(4.0).alias("Memory_Capacity"),
    )
    key = F.when(F.col("id") % 2 == 0, F.lit("20")).when(F.col("id") % 9 == 0, F.lit(None)).otherwise((F.col("id") % 500).cast("string"))
    prices = spark.range(0, 8000, 1, 4).select(
        key.alias("ProdId"), F.concat(F.lit("d"), F.col("id") % 7).alias("TimeId"), F.lit("r").alias("RegionId"), (F.col("id") % 3).cast("string").alias("MerchantId"),
        (F.col("id") % 11).cast("double").alias("Price_USD"), (F.col("id") % 11 / 2).alias("Price_Original"),
    )
    basket = spark.createDataFrame([(f"d{i}", 1.0, "ONE", 1, 2.0) for i in range(5)], "TimeId string, High double, Currency_Name string, Number_Of_Mineable_Coins long, Avg_Crypto_Rate double")
    few = DailyPrices.of(prices, products, basket)
    expected = rows(peer_mean(attach_daily_map(enrich_facts(prices, products), basket), "NV", drop=("RegionId", "MerchantId")).select(*few.peer_mean("NV").columns))
    assert rows(few.peer_mean("NV")) == expected != []
    # past the bound, also where the product ids are of another type than the prices' or repeat
    typed = products.withColumn("Id", F.col("Id").cast("int"))
    repeated = products.unionByName(products)
    for theirs in (products, typed, repeated):
        many = DailyPrices.of(prices, theirs, basket, max_products=1)
        assert rows(many.peer_mean("NV").select(*few.peer_mean("NV").columns)) == expected
    # only the maker's prices are shuffled (and a few that share a bit of the filter)
    daily = DailyPrices.of(prices, products, basket, max_products=1)
    wanted = daily.products.where("Processor_Manufacturer = 'NV'")
    met = []
    real = market.join_dimension
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(market, "join_dimension", lambda facts, *a, **k: met.append(facts.count()) or real(facts, *a, **k))
        kept = daily._distinct(wanted, False).count()
    theirs = prices.join(wanted, prices.ProdId == wanted.Id, "left_semi").where("TimeId < 'd5'")
    assert kept == theirs.distinct().count()
    assert theirs.count() <= met[0] <= theirs.count() * 1.1 < prices.count()
