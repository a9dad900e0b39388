import json

from tests.helpers import SF001, plan_text, rows

from tallyspark.operators import attach_daily_map, daily_basket, enrich_facts, peer_mean, period_comparison
from tallyspark.plans.fixtures import typed_fixture

PRICES = "ProdId string, TimeId string, RegionId string, MerchantId string, Price_USD double, Price_Original double"
PRODUCTS = "Id string, Processor_Manufacturer string, Processor string, GPU_Manufacturer string, Memory_Capacity double"
BASKET = "TimeId string, High double, Currency_Name string, Number_Of_Mineable_Coins long, Avg_Crypto_Rate double"


def test_enrich_facts_capacity_filter(spark):
    prices = spark.createDataFrame([("1", "d", "r", "m", 1.0, 1.0), ("2", "d", "r", "m", 1.0, 1.0), ("3", "d", "r", "m", 1.0, 1.0), ("4", "d", "r", "m", 1.0, 1.0)], PRICES)
    products = spark.createDataFrame([("1", "b", "p", "g", 1.9), ("2", "b", "p", "g", 2.0), ("3", "b", "p", "g", 2.5), ("4", "b", "p", "g", None)], PRODUCTS)
    out = enrich_facts(prices, products)
    assert [r.ProdId for r in out.orderBy("ProdId").collect()] == ["2", "3"]
    assert "Id" not in out.columns


def test_attach_daily_map_dedups_and_sorts_coins(spark):
    prices = spark.createDataFrame([("1", "d", "r", "m", 5.0, 4.0), ("1", "d", "r", "m", 5.0, 4.0)], PRICES)
    basket = spark.createDataFrame([("d", 2.0, "ZED", 2, 7.0), ("d", 3.0, "ALPHA", 2, 7.0)], BASKET)
    basket_rev = spark.createDataFrame([("d", 3.0, "ALPHA", 2, 7.0), ("d", 2.0, "ZED", 2, 7.0)], BASKET)
    a = attach_daily_map(prices, basket).collect()
    b = attach_daily_map(prices, basket_rev).collect()
    assert len(a) == 1 and a == b
    assert json.loads(a[0].Coin_Map) == [{"ALPHA": 3.0}, {"ZED": 2.0}]


def test_daily_basket_counts_and_sums(spark):
    rates = spark.createDataFrame(
        [("d1", "1", 1.0, 3.0, 4.0, 0.0), ("d1", "2", 2.0, 2.0, 2.0, 2.0), ("d1", "5", 9.0, 9.0, 9.0, 9.0), ("d2", "1", 4.0, 4.0, 4.0, 4.0)],
        "TimeId string, CodeId string, Open double, Close double, High double, Low double",
    )
    coins = spark.createDataFrame([("1", "C1", "ONE", 1), ("2", "C2", "TWO", 1), ("5", "C5", "FIVE", 0)], "Id string, Code string, Currency_Name string, Is_Mineable int")
    got = rows(daily_basket(rates, coins))
    assert got == [("d1", 2.0, "TWO", 2, 4.0), ("d1", 4.0, "ONE", 2, 4.0), ("d2", 4.0, "ONE", 1, 4.0)]


def test_market_chain_plans(spark):
    basket = daily_basket(typed_fixture(spark, SF001, "crypto_rate"), typed_fixture(spark, SF001, "crypto_dim"))
    enriched = enrich_facts(typed_fixture(spark, SF001, "gpu_price"), typed_fixture(spark, SF001, "gpu_dim"))
    attached = attach_daily_map(enriched, basket)
    plan = plan_text(attached)
    # dimensions and the per-day map are broadcast; the price fact is not fanned out by coin
    assert "BroadcastHashJoin" in plan
    nv = peer_mean(attached, "Brand#1")
    out = period_comparison(nv, typed_fixture(spark, SF001, "time_dim"))
    p = plan_text(out)
    assert "Window" not in p
    assert out.count() == nv.count()


def test_peer_mean_one_row_per_product_day(spark):
    df = spark.createDataFrame(
        [("1", "d", "r1", "m1", 10.0, 8.0, "NV"), ("1", "d", "r2", "m2", 20.0, 16.0, "NV"), ("2", "d", "r1", "m1", 1.0, 1.0, "AMD")],
        PRICES + ", Processor_Manufacturer string",
    )
    out = peer_mean(df, "NV")
    assert out.columns == ["ProdId", "TimeId", "Price_USD", "Price_Original", "Processor_Manufacturer"]
    assert rows(out) == [("1", "d", 15.0, 12.0, "NV")]


def test_broadcast_check_bounds_rows_and_bytes(spark):
    from tallyspark.operators.joins import broadcast_if_small, materialize_small

    small = spark.createDataFrame([(str(i), "x" * 10) for i in range(100)], "k string, v string")
    facts = spark.range(1000).selectExpr("cast(id % 100 as string) as k")
    assert "BroadcastHashJoin" in plan_text(facts.join(broadcast_if_small(small), "k"))
    # over the byte bound: no hint, the planner decides (autoBroadcast disabled here)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_text(facts.join(broadcast_if_small(small, max_bytes=100), "k"))
        assert "BroadcastHashJoin" not in plan_text(facts.join(broadcast_if_small(small, max_rows=10), "k"))
        staged = materialize_small(small.groupBy("k").count())
        assert "BroadcastHashJoin" in plan_text(facts.join(staged, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_total_order_spreads_hot_key(spark):
    from tallyspark.operators.joins import total_order

    df = spark.createDataFrame([("p", "d", str(i)) for i in range(50)], "ProdId string, TimeId string, MerchantId string")
    keys = [c._jc.toString() for c in total_order(df, "ProdId", "TimeId")]
    assert keys[:2] == ["ProdId", "TimeId"] and "MerchantId" in keys[2]
    ordered = df.orderBy(*total_order(df, "ProdId", "TimeId"))
    assert [r.MerchantId for r in ordered.collect()] == sorted(str(i) for i in range(50))
