import re

from tests.helpers import SF001, plan_text, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyspark.operators import balance, balance_by_period, balance_from_totals, balance_leaderboard, clean_rows, totals_since
from tallyspark.plans.fixtures import fixture

SCHEMA = "country_or_area string, year int, flow string, trade_usd long"


def trade(spark):
    return clean_rows(fixture(spark, SF001, "trade"))


def test_balance_by_period_one_sided_years_vanish(spark):
    df = spark.createDataFrame(
        [("P", 2000, "Export", 5), ("P", 2000, "Import", 3), ("P", 2001, "Import", 9), ("P", 2002, "Export", 4)], SCHEMA
    )
    got = rows(balance_by_period(df), "country_or_area", "year", "export_total", "import_total", "saldo", "saldo_str")
    assert got == [("P", 2000, 5, 3, 2, "2")]


def test_balance_by_period_single_country(spark):
    df = spark.createDataFrame(
        [("P", 2000, "Export", 5), ("P", 2000, "Import", 3), ("Q", 2000, "Export", 1), ("Q", 2000, "Import", 1)], SCHEMA
    )
    assert rows(balance_by_period(df, country="Q"), "country_or_area", "saldo") == [("Q", 0)]


def test_balance_by_period_equals_lead_form(spark):
    t = trade(spark)
    per = t.filter(F.col("flow").isin("Import", "Export")).groupBy("country_or_area", "flow", "year").agg(
        F.sum("trade_usd").alias("export_total")
    )
    w = Window.partitionBy("country_or_area", "year").orderBy("flow", "year")
    ref = (
        per.withColumn("import_total", F.lag("export_total", -1).over(w))
        .withColumn("saldo", F.col("export_total") - F.col("import_total"))
        .filter(F.col("saldo").isNotNull())
        .drop("flow")
    )
    new = balance_by_period(t).drop("saldo_str")
    cols = ["country_or_area", "year", "export_total", "import_total", "saldo"]
    assert rows(ref, *cols) == rows(new, *cols)
    assert len(rows(new)) == 98


def test_balance_all_null_side_kept_with_null_saldo(spark):
    df = spark.createDataFrame(
        [("P", 2000, "Export", 5), ("P", 2000, "Import", None), ("Q", 2000, "Export", 5), ("R", 2000, "Import", 1)], SCHEMA
    )
    got = rows(balance(df, 1990), "country_or_area", "overall_export", "overall_import", "saldo")
    assert got == [("P", 5, None, None)]


def test_balance_one_pass_equals_join_form(spark):
    t = trade(spark)
    joined = balance_from_totals(totals_since(t, "Export", 1998), totals_since(t, "Import", 1998))
    one_pass = balance(t, 1998)
    assert rows(joined) == rows(one_pass)
    assert len(rows(one_pass)) == 14


def test_balance_one_pass_single_scan(spark):
    plan = plan_text(balance(trade(spark), 1998))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M)) == 1


def test_leaderboard_is_top_k(spark):
    out = balance_leaderboard(balance(trade(spark), 1998), n=5)
    got = out.collect()
    assert len(got) == 5
    saldos = [r.saldo for r in got]
    assert saldos == sorted(saldos, reverse=True)
    assert "TakeOrderedAndProject" in plan_text(out)
