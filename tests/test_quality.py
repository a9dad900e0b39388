from tests.helpers import SF001, plan_text, rows

from tallyspark.operators import clean_rows, distinct_values, duplicate_keys
from tallyspark.sources import read_table


def test_clean_rows_edge_rows(spark):
    df = spark.createDataFrame(
        [("Bloc-25", "Import"), (None, "Import"), ("Peru", None), ("Peru", "Export")],
        "country_or_area string, flow string",
    )
    assert rows(clean_rows(df)) == [("Peru", "Export")]


def test_clean_rows_pushes_null_check_to_scan(spark):
    df = clean_rows(read_table(spark, SF001, "documents"), text_column="text", required=("lang",))
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(text), IsNotNull(lang)]" in plan


def test_duplicate_keys_null_key_reported(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "email string")
    got = rows(duplicate_keys(df, "email"))
    assert got == [("b", 2), (None, 2)] or got == [(None, 2), ("b", 2)]


def test_duplicate_keys_multi_column(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a long, b int")
    assert rows(duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (2, 1, 3)]


def test_duplicate_keys_fingerprint_pass_equals_direct(spark):
    docs = read_table(spark, SF001, "documents")
    direct = duplicate_keys(docs, "text", hash_prefilter=False)
    hashed = duplicate_keys(docs, "text", hash_prefilter=True)
    assert rows(direct) == rows(hashed)
    assert len(rows(hashed)) == 62
    pairs = read_table(spark, SF001, "lineitem")
    assert rows(duplicate_keys(pairs, ["l_orderkey", "l_linenumber"], hash_prefilter=True)) == rows(
        duplicate_keys(pairs, ["l_orderkey", "l_linenumber"], hash_prefilter=False)
    )


def test_duplicate_keys_wide_key_does_not_shuffle_text_first(spark):
    docs = read_table(spark, SF001, "documents")
    plan = duplicate_keys(docs, "text", hash_prefilter=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan


def test_distinct_values(spark):
    part = read_table(spark, SF001, "part")
    got = [r[0] for r in distinct_values(part, "p_type").collect()]
    assert got == sorted(got) and len(got) == 6


def test_duplicate_keys_exact_under_fingerprint_collisions(spark):
    from pyspark.sql import functions as F

    docs = read_table(spark, SF001, "documents")
    # every row gets the same fingerprint: the exact regrouping alone must decide
    collided = duplicate_keys(docs, "text", hash_prefilter=True, fingerprints=(F.lit(7).cast("long"), F.lit(1)))
    assert rows(collided) == rows(duplicate_keys(docs, "text", hash_prefilter=False))
