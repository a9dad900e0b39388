"""Stand-in tables: the trade feed's plan against the SQL that defines it, and what is shuffled and
written for a large table."""

from datetime import datetime

from tallyspark.plans import fixtures
from tallyspark.scratch import new_folder
from tallyspark.sources.files import list_names
from tests.helpers import SF0001, plan_text, rows

DAY = datetime(2000, 5, 1)
# Keys that repeat (a supplier, a customer, a part, an order, a nation), are null or have no partner.
ODD = {
    "nation": ("n_nationkey int, n_name string", [(1, "N_1"), (2, "N_2"), (2, "N_2b"), (3, None), (None, "N_9")]),
    "supplier": ("s_suppkey long, s_nationkey int", [(1, 1), (1, 2), (11, 3), (5, None), (None, 1), (6, 77)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 1), (1, 1), (9, 2), (7, 3), (None, 2)]),
    "part": ("p_partkey long, p_name string, p_type string", [(1, "a", "x"), (2, "b", None), (2, "c", "y"), (None, "d", "z")]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp",
        [(1, 1, DAY), (2, 9, datetime(1999, 1, 1)), (50, 1, DAY), (3, None, DAY), (4, 404, DAY), (5, 7, None), (5, 9, DAY), (None, 1, DAY)],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_extendedprice double",
        [(o, p, s, 10.005 * o + s) for o in (1, 2, 3, 4, 5, 50, 99) for p in (1, 2, 3) for s in (1, 5, 6, 11, 404)]
        + [(1, 1, None, 7.0), (1, None, 1, 7.0), (None, 1, 1, 7.0), (1, 1, 1, None), (1, 1, 1, 3.0), (1, 1, 1, 3.0)],
    ),
}


def test_trade_has_the_rows_of_its_sql(spark):
    sf = new_folder(spark, "tests", "odd-trade")
    for name, (schema, data) in ODD.items():
        spark.createDataFrame(data, schema).write.parquet(f"{sf}/{name}.parquet")
        spark.read.parquet(f"{sf}/{name}.parquet").createOrReplaceTempView(name)
    spark.sql(fixtures.FIXTURE_SQL["trade_base"]).createOrReplaceTempView("trade_base")
    want, got = spark.sql(fixtures.FIXTURE_SQL["trade"]), fixtures.fixture(spark, sf, "trade")
    assert got.dtypes == want.dtypes
    assert rows(got) == rows(want) and got.count() > 100


def test_trade_is_written_once_and_lines_are_shuffled_without_text(spark):
    sf = f"{SF0001}/./."
    fixtures.fixture(spark, sf, "trade")
    folders = list_names(spark, fixtures.scratch_path(spark, "fixtures"))
    keys = {name: fixtures._key(sf, name) for name in ("trade", "trade_base")}
    assert f"trade_base-{keys['trade_base']}" in folders and f"trade-{keys['trade']}" not in folders
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(fixtures._trade_base(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in plan.split("\nInput")[1:] if "partitioning(" in line.split("\n")[1] and "trade_usd" in line.split("\n")[0]]
    assert len(moved) == 2  # by order, by part
    assert not any("country_or_area" in m.split("\n")[0] or "commodity" in m.split("\n")[0] for m in moved)


def test_large_tables_are_written_where_their_rows_lie(spark, monkeypatch):
    plans = {}
    real = fixtures.materialize

    def seen(df, path, **options):
        plans[path.rpartition("/")[2].partition("-")[0]] = plan_text(df)
        return real(df, path, **options)

    monkeypatch.setattr(fixtures, "materialize", seen)
    monkeypatch.setattr(fixtures, "row_group_bytes", lambda spark, sf_dir: 64 << 20)
    for name in ("gpu_price", "loans_ibrd", "trade"):
        fixtures.fixture(spark, f"{SF0001}/./", name).count()
    assert {"gpu_price", "loans_ibrd", "trade_base"} <= plans.keys()
    assert not any("RoundRobin" in plan or "Rebalance" in plan or "REBALANCE" in plan for plan in plans.values())
