import datetime as dt

from tests.helpers import SF001, plan_text, rows

from tallyspark.operators import (
    blended_rate,
    group_profile,
    harmonize_columns,
    open_position,
    open_share_of_total,
    share_of_total,
)
from tallyspark.plans.fixtures import fixture

LOANS = "country string, original_principal_amount long, interest_rate double, loan_status string, last_repayment_date string"


def test_share_of_total_percentages(spark):
    df = spark.createDataFrame(
        [("a", 30, 1.0, "Repaying", None), ("b", 10, 1.0, "Repaying", None), ("a", 60, 1.0, "Repaying", None)], LOANS
    )
    got = rows(share_of_total(df))
    assert got == [("a", 90, 100, 90.0), ("b", 10, 100, 10.0)]


def test_share_of_total_zero_total_is_null(spark):
    df = spark.createDataFrame([("a", 0, 1.0, "Repaying", None)], LOANS)
    assert rows(share_of_total(df)) == [("a", 0, 0, None)]


def test_share_of_total_has_no_global_window(spark):
    plan = plan_text(share_of_total(fixture(spark, SF001, "loans_ibrd")))
    assert "Window" not in plan


def test_group_profile_counts_key_not_rows(spark):
    df = spark.createDataFrame(
        [(None, 5, 2.0, "Repaying", None), (None, 7, 4.0, "Repaying", None), ("x", 1, 1.0, "Repaying", None)], LOANS
    )
    got = rows(group_profile(df))
    assert got == [("x", 1, 1.0, 1), (None, 0, 3.0, 12)]


def test_group_profile_no_window(spark):
    assert "Window" not in plan_text(group_profile(fixture(spark, SF001, "loans_ibrd")))


def test_open_share_drops_null_and_closed_status(spark):
    df = spark.createDataFrame(
        [
            ("a", 10, 1.0, None, None),
            ("a", 20, 1.0, "Fully Repaid", None),
            ("a", 30, 1.0, "Fully Cancelled", None),
            ("a", 40, 1.0, "Disbursed", None),
        ],
        LOANS,
    )
    assert rows(open_share_of_total(df)) == [("a", 40, 40, 100.0)]


def test_open_position_max_is_a_date_max(spark):
    df = spark.createDataFrame(
        [("a", 1, 1.0, "Repaying", "12/01/1999 00:00:00"), ("a", 1, 3.0, "Repaying", "01/15/2040 00:00:00")], LOANS
    )
    got = rows(open_position(df))
    assert got == [("a", 2, 2.0, dt.date(2040, 1, 15))]
    assert "Window" not in plan_text(open_position(fixture(spark, SF001, "loans_ibrd")))


def test_blended_rate_zero_weight_is_null(spark):
    pos = spark.createDataFrame([("a", 10, 2.0, dt.date(2000, 1, 1))], "country string, total_loans_amount long, avg_interest_rate double, due_date date")
    out = blended_rate(pos, pos, "2000-01-01").collect()
    assert out[0].avg_interest_rate is None and out[0].total_loans_amount == 20


def test_blended_rate_weights(spark):
    a = spark.createDataFrame([("a", 100, 2.0, dt.date(2000, 1, 11))], "country string, total_loans_amount long, avg_interest_rate double, due_date date")
    b = spark.createDataFrame([("a", 100, 4.0, dt.date(2000, 1, 11)), ("z", 1, 1.0, dt.date(2000, 1, 2))], "country string, total_loans_amount long, avg_interest_rate double, due_date date")
    out = blended_rate(a, b, "2000-01-01").collect()
    # weights 10*2*100=2000 and 10*4*100=4000 -> (2*2000 + 4*4000) / 6000
    assert len(out) == 1 and out[0].avg_interest_rate == round(20000 / 6000, 3)
    assert out[0].ibrd_interest_rate == 2.0 and out[0].ida_loans == 100


def test_blended_rate_fixture_range(spark):
    loans = fixture(spark, SF001, "loans_ibrd")
    credits = harmonize_columns(fixture(spark, SF001, "credits_ida"))
    out = blended_rate(open_position(loans), open_position(credits), "2000-01-01").collect()
    assert len(out) == 14
    rates = [r.avg_interest_rate for r in out]
    assert min(rates) >= 4.5 and max(rates) <= 5.1


def test_harmonize_columns(spark):
    credits = fixture(spark, SF001, "credits_ida")
    out = harmonize_columns(credits)
    assert out.columns == ["country", "original_principal_amount", "interest_rate", "loan_status", "last_repayment_date"]


def test_share_of_total_reuses_the_aggregate_shuffle(spark):
    df = share_of_total(fixture(spark, SF001, "loans_ibrd"))
    df.collect()  # the final adaptive plan is known after execution
    plan = plan_text(df)
    assert "ReusedExchange" in plan and "Window" not in plan
