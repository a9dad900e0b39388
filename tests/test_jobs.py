"""Whole jobs over CSV feeds written from the stand-in tables, checked against the registered
queries (which read the same data from Parquet)."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tallyspark.plans import jobs, registry
from tallyspark.plans.fixtures import fixture
from tallyspark.sources import read_table
from tallyspark.streaming import snapshot_batch
from tests.helpers import SF001, SF0001, rows

LOAN_HEADERS = {
    "country": "Country",
    "original_principal_amount": "Original Principal Amount",
    "interest_rate": "Interest Rate",
    "loan_status": "Loan Status",
    "last_repayment_date": "Last Repayment Date",
}
CREDIT_HEADERS = {
    "country": "Country",
    "original_principal_amount": "Original Principal Amount",
    "service_charge_rate": "Service Charge Rate",
    "credit_status": "Credit Status",
    "last_repayment_date": "Last Repayment Date",
}


def _csv(df, path, headers=None):
    (df.withColumnsRenamed(headers) if headers else df).write.option("header", "true").csv(path)
    return path


@pytest.fixture(scope="module")
def base():
    return tempfile.mkdtemp(prefix="tallyspark-jobs-")


def test_trade_job_matches_registered_queries(spark, base):
    path = _csv(fixture(spark, SF001, "trade"), f"{base}/trade.csv")
    reports = jobs.trade_reports(spark, path, f"{base}/trade_out", since=registry.SINCE_YEAR, countries=[registry.ONE_COUNTRY])
    q = registry.queries()
    for name in ("balance", "period_totals", "leader_in_group", "ranked_totals_category", "top_with_ties", "balance_by_period"):
        assert rows(reports[name]) == rows(q[name](spark, SF001)), name
    assert rows(reports[f"balance_by_period:{registry.ONE_COUNTRY}"]) == rows(q["balance_by_period_country"](spark, SF001))


def test_loan_job_normalises_harmonises_and_blends(spark, base):
    loans = _csv(fixture(spark, SF001, "loans_ibrd"), f"{base}/loans.csv", LOAN_HEADERS)
    credits = _csv(fixture(spark, SF001, "credits_ida"), f"{base}/credits.csv", CREDIT_HEADERS)
    reports = jobs.loan_reports(spark, loans, credits, f"{base}/loan_out", registry.AS_OF_DATE)
    q = registry.queries()
    assert rows(reports["blended_rate"]) == rows(q["blended_rate"](spark, SF001))
    assert rows(reports["loans:totals"]) == rows(q["loan_totals"](spark, SF001))
    assert rows(reports["credits:open_share"]) == rows(q["open_credit_share"](spark, SF001))
    r4 = lambda df: df.withColumn("avg_interest_rate", F.round("avg_interest_rate", 4))
    assert rows(r4(reports["credits:profile"])) == rows(q["credit_profile"](spark, SF001))


def test_market_job_from_csv_folder(spark, base):
    folder = f"{base}/market"
    for role, stem in jobs.MARKET_TABLES.items():
        name = {"rates": "crypto_rate", "coins": "crypto_dim", "prices": "gpu_price", "products": "gpu_dim", "days": "time_dim"}[role]
        _csv(fixture(spark, SF001, name), f"{folder}/{stem}.csv")
    reports = jobs.market_reports(spark, folder, registry.MANUFACTURER)
    q = registry.queries()
    assert rows(reports["period_comparison"]) == rows(q["period_comparison"](spark, SF001))
    assert reports["attach_daily_map"].count() == q["attach_daily_map"](spark, SF001).count()


def test_duplicate_job(spark, base):
    path = _csv(read_table(spark, SF001, "customer"), f"{base}/customer.csv")
    reports = jobs.duplicate_reports(spark, path, ["c_name", "c_nationkey", "c_mktsegment"], f"{base}/customer_out")
    assert rows(reports["all_columns"]) == rows(registry.queries()["duplicate_values_customer"](spark, SF001))
    assert reports["c_nationkey"].count() == 25


def test_process_monitor_available_now(spark, base):
    path = registry.snapshot_files(spark, SF0001)
    q = jobs.process_monitor(spark, path, f"{base}/monitor_out", f"{base}/monitor_ckpt", processing_time=None)
    q.awaitTermination()
    got = spark.read.parquet(f"{base}/monitor_out")
    expected = snapshot_batch(spark, path).groupBy("name").agg(F.sum("memory_percent").alias("total_memory_percent"))
    r = lambda df: df.select("name", F.round("total_memory_percent", 6))
    assert rows(r(got)) == rows(r(expected))
