from tests.helpers import SF001, plan_text, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.functions import magnitude_label
from tallyspark.operators import (
    clean_rows,
    leader_in_group,
    period_totals,
    ranked_means,
    ranked_totals,
    top_with_ties,
    totals_since,
)
from tallyspark.plans.fixtures import fixture

SCHEMA = "country_or_area string, year int, comm_code string, commodity string, category string, flow string, trade_usd long"


def trade(spark):
    return clean_rows(fixture(spark, SF001, "trade"))


def test_top_with_ties_keeps_ties_and_drops_all_null_groups(spark):
    df = spark.createDataFrame(
        [
            ("A", 2000, "1", "x", "c", "Export", 5),
            ("A", 2001, "2", "y", "c", "Export", 5),
            ("A", 2001, "3", "z", "c", "Export", 1),
            ("B", 2000, "1", "x", "c", "Export", None),
            ("B", 2000, "2", "x", "c", "Export", None),
            ("C", 2000, "TOTAL", "x", "c", "Import", 99),
            ("C", 2000, "4", "x", "c", "Import", 7),
        ],
        SCHEMA,
    )
    got = rows(top_with_ties(df, exclude={"comm_code": "TOTAL"}), "country_or_area", "comm_code", "biggest_trade")
    assert got == [("A", "1", "5"), ("A", "2", "5"), ("C", "4", "7")]


def test_top_with_ties_has_no_window(spark):
    plan = plan_text(top_with_ties(trade(spark), exclude={"comm_code": "TOTAL"}))
    assert "Window" not in plan


def test_top_with_ties_equals_window_form(spark):
    t = trade(spark).filter(F.col("comm_code") != "TOTAL")
    w = Window.partitionBy("country_or_area", "flow")
    ref = t.withColumn("mx", F.max("trade_usd").over(w)).filter(F.col("mx") == F.col("trade_usd")).drop("mx")
    new = top_with_ties(trade(spark), exclude={"comm_code": "TOTAL"}, label=False).drop("biggest_trade")
    assert rows(ref) == rows(new)


def test_ranked_totals_sorted_and_labelled(spark):
    out = ranked_totals(trade(spark), ["category", "flow"], "trade_usd", exclude={"category": "all_commodities"})
    sums = [r.overall_sum for r in out.collect()]
    assert sums == sorted(sums, reverse=True)
    labelled = ranked_totals(
        trade(spark), ["category", "flow"], "trade_usd", exclude={"category": "all_commodities"}, label=True
    )
    assert all(r.overall_sum.endswith((" bil", " mil", " tri")) or r.overall_sum.lstrip("-").isdigit() for r in labelled.collect())


def test_ranked_means_null_group_first(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("c", 0.5)], "country string, interest_rate double")
    got = [(r.country, r.avg_interest_rate) for r in ranked_means(df).collect()]
    assert got == [("b", None), ("c", 0.5), ("a", 2.0)]


def test_leader_in_group_ties(spark):
    df = spark.createDataFrame(
        [
            ("A", 2000, "1", "x", "c1", "Export", 10),
            ("A", 2000, "2", "y", "c1", "Export", 10),
            ("A", 2000, "3", "z", "c1", "Export", 4),
            ("A", 2000, "3", "z", "all_commodities", "Export", 100),
        ],
        SCHEMA,
    )
    out = leader_in_group(df, exclude={"category": "all_commodities"}, label=False)
    assert rows(out) == [("x", "Export", "c1", 24, 10), ("y", "Export", "c1", 24, 10)]


def test_leader_in_group_equals_plain_python(spark):
    sums = {}
    for r in trade(spark).filter(F.col("category") != "all_commodities").select("commodity", "category", "flow", "trade_usd").collect():
        if r.category is not None:
            sums.setdefault((r.category, r.flow), {}).setdefault(r.commodity, []).append(r.trade_usd or 0)
    expected = set()
    for (category, flow), goods in sums.items():
        totals = {g: sum(v) for g, v in goods.items()}
        expected |= {(g, flow, category) for g, t in totals.items() if abs(t - max(totals.values())) < 1e-6 * abs(t)}
    new = leader_in_group(trade(spark), exclude={"category": "all_commodities"}, label=False)
    assert {(r.commodity, r.flow, r.category) for r in new.collect()} == expected


def test_period_totals_equals_window_distinct_form(spark):
    t = trade(spark)
    w = Window.partitionBy("country_or_area", "year", "flow")
    ref = (
        t.withColumn("overall_sum", F.sum("trade_usd").over(w))
        .select("country_or_area", "flow", "year", "overall_sum")
        .distinct()
        .withColumn("overall_sum_str", magnitude_label("overall_sum"))
    )
    new = period_totals(t)
    assert rows(ref) == rows(new)


def test_totals_since_one_aggregate_no_window(spark):
    out = totals_since(trade(spark), "Import", 1998)
    plan = plan_text(out)
    assert "Window" not in plan
    # the filter reaches the Parquet scan of the derived table
    assert "GreaterThanOrEqual(year,1998), EqualTo(flow,Import)]" in plan
    assert "ReadSchema: struct<country_or_area:string,year:int,flow:string,trade_usd:bigint>" in plan


def test_totals_since_equals_window_distinct_form(spark):
    t = trade(spark)
    src = t.withColumn("year", F.col("year").cast("int")).filter((F.col("year") >= 1998) & (F.col("flow") == "Export"))
    ref = (
        src.withColumn("overall_sum", F.sum("trade_usd").over(Window.partitionBy("country_or_area", "flow")))
        .select("country_or_area", "flow", "overall_sum")
        .distinct()
    )
    new = totals_since(t, "Export", 1998).drop("overall_sum_str")
    assert rows(ref) == rows(new)
