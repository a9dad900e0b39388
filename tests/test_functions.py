import datetime as dt

from pyspark.sql import functions as F

from tallyspark.functions import days_until, exact_totals, magnitude_label, parse_date


def test_magnitude_label_boundaries(spark):
    values = [999999, 1000000, 999999999, 1000000000, 999999999999, 1000000000000, -1500000000, None]
    expected = ["999999", "1 mil", "999 mil", "1 bil", "999 bil", "1 tri", "-1 bil", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x long")
    got = [r.label for r in df.orderBy("i").select(magnitude_label("x").alias("label")).collect()]
    assert got == expected


def test_magnitude_label_large_and_negative(spark):
    df = spark.createDataFrame([(-999999,), (-1000000,), (2_500_000_000_000,), (0,)], "x long")
    got = sorted(r[0] for r in df.select(magnitude_label("x")).collect())
    assert got == sorted(["-999999", "-1 mil", "2 tri", "0"])


def test_magnitude_label_stays_in_codegen(spark):
    df = spark.range(10).select(magnitude_label(F.col("id") * 1_000_000).alias("l"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_parse_date_bad_text_is_null(spark):
    df = spark.createDataFrame([("12/01/1999 00:00:00",), ("not a date",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_date("t")).collect()]
    assert got == [dt.date(1999, 12, 1), None, None]


def test_days_until(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 11),), (dt.date(1999, 12, 31),)], "d date")
    got = [r[0] for r in df.select(days_until("d", "2000-01-01")).collect()]
    assert got == [10, -1]


def test_exact_sum_is_order_free(spark):
    vals = [0.1, 0.2, 0.3, 12345.6789, -0.05, None]
    a = spark.createDataFrame([(1, v) for v in vals], "k int, v double").repartition(3)
    b = spark.createDataFrame([(1, v) for v in reversed(vals)], "k int, v double").repartition(2)
    ra = exact_totals(a, ["k"], sums={"s": "v"}).collect()[0].s
    rb = exact_totals(b, ["k"], sums={"s": "v"}).collect()[0].s
    assert ra == rb == 12346.2289
    empty = spark.createDataFrame([(1, None)], "k int, v double")
    assert exact_totals(empty, ["k"], sums={"s": "v"}).collect()[0].s is None


def test_exact_mean_matches_decimal_math(spark):
    df = spark.createDataFrame([(1, 30972.85), (1, 30972.86)], "k int, v double")
    means = exact_totals(df, ["k"], means={"m": "v"})
    assert means.collect()[0].m == 30972.855
    assert means.select(F.round("m", 2).alias("m")).collect()[0].m == 30972.86
