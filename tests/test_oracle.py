"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest
from tests.helpers import SF001, SF0001, plan_text

from __spark_entry__ import entry
from tallyspark.plans.registry import oracle_sql, queries
from tests.oracle import compare, duck

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "flow", "overall_sum"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, queries()[name], oracle_sql()[name], SF001)
    assert res["ok"], res


@pytest.mark.parametrize("name", [n for n in NAMES if not n.startswith(("running_totals", "fresh_snapshots"))])
def test_no_python_in_plan(spark, name):
    plan = plan_text(queries()[name](spark, SF0001))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
