import tempfile

import pytest
from tests.helpers import SF001, rows

from tallyspark.sources import is_complete, load_tables, materialize_parquet, normalize_columns, read_csv, read_table


def _tmp():
    return tempfile.mkdtemp(prefix="tallyspark-test-")


def test_normalize_columns_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Original Principal Amount (US$)` long, `Last Repayment Date` long")
    assert normalize_columns(df).columns == ["original_principal_amount_us$", "last_repayment_date"]


def test_normalize_columns_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` long, `a_B` long")
    with pytest.raises(ValueError, match="collide"):
        normalize_columns(df)


def test_csv_round_trip_and_parquet_copy(spark):
    base = _tmp()
    nation = read_table(spark, SF001, "nation")
    nation.write.option("header", "true").csv(f"{base}/nation.csv")
    back = read_csv(spark, f"{base}/nation.csv")
    assert back.schema == nation.schema
    assert rows(back) == rows(nation)
    first = materialize_parquet(spark, f"{base}/nation.csv", f"{base}/out")
    assert is_complete(spark, f"{base}/out/parquet")
    second = materialize_parquet(spark, f"{base}/does-not-exist.csv", f"{base}/out")  # served from the copy
    assert rows(first) == rows(second) == rows(nation)


def test_materialize_leaves_a_foreign_folder_alone(spark):
    base = _tmp()
    read_table(spark, SF001, "region").write.option("header", "true").csv(f"{base}/region.csv")
    spark.range(3).write.parquet(f"{base}/out/parquet")
    import os

    os.remove(f"{base}/out/parquet/_SUCCESS")
    with pytest.raises(FileExistsError):
        materialize_parquet(spark, f"{base}/region.csv", f"{base}/out")
    assert spark.read.parquet(f"{base}/out/parquet").count() == 3


def test_load_tables_from_copies_alone(spark):
    base = _tmp()
    spark.range(3).write.parquet(f"{base}/parquet/kept")
    assert load_tables(spark, base)["kept"].count() == 3


def test_load_tables_all_strings(spark):
    base = _tmp()
    for t in ("nation", "region"):
        read_table(spark, SF001, t).write.option("header", "true").csv(f"{base}/{t}.csv")
    tables = load_tables(spark, base)
    assert sorted(tables) == ["nation", "region"]
    assert all(f.dataType.simpleString() == "string" for f in tables["nation"].schema.fields)
    assert tables["region"].count() == 5
    assert is_complete(spark, f"{base}/parquet/nation")
    again = load_tables(spark, base, register_views=True)
    assert rows(again["nation"]) == rows(tables["nation"])
    assert spark.sql("SELECT count(*) AS n FROM region").first().n == 5


def test_read_csv_with_a_schema(spark):
    base = _tmp()
    part = read_table(spark, SF001, "part")
    part.write.option("header", "true").csv(f"{base}/part.csv")
    typed = read_csv(spark, f"{base}/part.csv", schema=part.schema)
    assert typed.schema == part.schema and typed.count() == part.count()
