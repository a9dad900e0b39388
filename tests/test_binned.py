"""Exact sums: against rational arithmetic, and equal bit for bit however the rows lie."""

import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import exact_totals, final_totals, partial_totals
from tallyspark.operators import group_profile, open_position, ranked_means, ranked_totals


def frame(spark, groups):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(len(rows)).shuffle(rows)
    return spark.createDataFrame(rows, "k long, v double")


def both(df):
    return {r.k: (r.s, r.m) for r in exact_totals(df, ["k"], sums={"s": "v"}, means={"m": "v"}).collect()}


def assert_exact(values, got):
    held = [v for v in values if v is not None]
    total = sum(map(Fraction, held), Fraction(0))
    assert abs(Fraction(got[0]) - total) <= Fraction(math.ulp(float(total)))
    assert abs(Fraction(got[1]) - total / len(held)) <= 2 * Fraction(math.ulp(float(total / len(held))))


def test_sums_of_all_magnitudes(spark):
    rng = random.Random(1)
    ranges = [(-1074, 1000), (-20, 20), (0, 3), (-1000, -990), (900, 1010), (-1074, -1020), (-40, 60)]
    groups = {}
    for k in range(70):
        low, high = ranges[k % len(ranges)]
        groups[k] = [rng.choice((-1, 1)) * rng.random() * 2.0 ** rng.randint(low, high) for _ in range(rng.randint(1, 40))]
        if k % 3 == 0:  # all but one cancel
            groups[k] += [-v for v in groups[k][:-1]]
        if k % 4 == 0:
            groups[k] += [0.0, -0.0, None]
    groups[100] = [math.nextafter(2.0**e, 0) for e in range(-1000, 1000)]  # where logarithms round up
    groups[101] = [2.0**e for e in range(-1074, 1000)]
    groups[102] = [1e300, 1e-300, -1e300]
    got = both(frame(spark, groups))
    for k, values in groups.items():
        assert_exact(values, got[k])
    assert got[102][0] == 1e-300


def test_bits_do_not_depend_on_partitions_or_order(spark):
    rng = random.Random(2)
    df = frame(spark, {k: [rng.uniform(-1, 1) * 10.0 ** rng.randint(-30, 30) for _ in range(200)] for k in range(5)})
    first = both(df.coalesce(1))
    for n in (3, 7, 16):
        assert both(df.repartition(n)) == first
    assert both(df.orderBy(F.col("v").desc())) == first


@settings(max_examples=6, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64, min_value=-1e300, max_value=1e300), min_size=1, max_size=30))
def test_any_values(spark, values):
    assert_exact(values, both(frame(spark, {1: values}))[1])


def test_nulls_infinities_and_empty_frames(spark):
    inf, nan = math.inf, math.nan
    got = both(frame(spark, {1: [None, None], 2: [inf, 1.0, None], 3: [inf, -inf], 4: [nan, 1.0], 5: [-inf, -1e300], 6: [-0.0]}))
    assert got[1] == (None, None) and got[2] == (inf, inf) and got[5] == (-inf, -inf) and got[6] == (0.0, 0.0)
    assert math.isnan(got[3][0]) and math.isnan(got[4][1])
    empty = frame(spark, {1: [1.0]}).where("false")
    assert both(empty) == {}
    assert [tuple(r) for r in exact_totals(empty, [], sums={"s": "v"}).collect()] == [(None,)]


def test_null_keys_integers_and_further_aggregates(spark):
    rows = [(None, 1.5, 2, "x"), (None, None, 3, None), ("a", 0.1, 4, "y"), ("a", 0.2, None, "z")]
    df = spark.createDataFrame(rows, "k string, v double, n long, t string")
    got = exact_totals(df, ["k"], sums={"v_sum": "v", "n_sum": "n"}, means={"n_mean": "n"}, counts={"texts": "t"}, maxima={"last": "t"})
    assert got.schema["n_sum"].dataType.simpleString() == "bigint"
    assert sorted(map(str, got.drop("last").collect())) == sorted(
        map(str, spark.createDataFrame([(None, 1.5, 2.5, 5, 1), ("a", 0.30000000000000004, 4.0, 4, 2)], "k string, v_sum double, n_mean double, n_sum long, texts long").select("k", "v_sum", "n_mean", "n_sum", "texts").collect())
    )
    assert {r.k: r.last for r in got.collect()} == {None: "x", "a": "z"}


def test_partial_rows_merge_across_batches(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-200, 200) for _ in range(300)]
    df = frame(spark, {1: values})
    parts = [partial_totals(df.where(F.hash("v") % 3 == r), ["k"], {"s": "v"}) for r in (-2, -1, 0, 1, 2)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    assert final_totals(merged, ["k"]).first().s == both(df)[1][0]


def test_a_hot_group_is_combined_before_the_shuffle(spark):
    from tests.helpers import plan_text

    df = spark.range(1000).select(F.lit(1).alias("k"), F.rand(5).alias("v"))
    plan = plan_text(exact_totals(df, ["k"], sums={"s": "v"}))
    assert "partial_sum" in plan and "Window" not in plan and "Python" not in plan


@pytest.mark.parametrize("report", ["means", "profile", "position", "totals"])
def test_reports_repeat_bit_for_bit(spark, report):
    rng = random.Random(4)
    rows = [(f"c{i % 7}", rng.uniform(0, 1e9), rng.uniform(0, 20), "Repaying", "01/02/2003 00:00:00") for i in range(2000)]
    df = spark.createDataFrame(rows, "country string, original_principal_amount double, interest_rate double, loan_status string, last_repayment_date string")
    build = {
        "means": ranked_means,
        "profile": group_profile,
        "position": open_position,
        "totals": lambda d: ranked_totals(d, "country", "original_principal_amount"),
    }[report]
    first = sorted(map(tuple, build(df.coalesce(1)).collect()))
    assert sorted(map(tuple, build(df.repartition(11)).collect())) == first
