"""Randomised checks against brute-force Python implementations of the same semantics."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyspark.functions import magnitude_label
from tallyspark.operators import balance, balance_by_period, leader_in_group, period_totals, top_with_ties

SCHEMA = "country_or_area string, year int, comm_code string, commodity string, category string, flow string, trade_usd long"


def label(x):
    if x is None:
        return None
    for factor, suffix in ((10**12, "tri"), (10**9, "bil"), (10**6, "mil")):
        q = abs(x) // factor * (1 if x >= 0 else -1)  # truncation toward zero
        if q != 0:
            return f"{q} {suffix}"
    return str(x)


def test_magnitude_label_random_longs(spark):
    rng = random.Random(7)
    values = [None, 0, -1, 10**6, -(10**6), 10**9 - 1, -(10**12), 9_223_372_036_854_775_807, -9_223_372_036_854_775_808]
    for _ in range(3000):
        e = rng.randint(0, 18)
        values.append(rng.choice([-1, 1]) * rng.randint(0, 10**e))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x long")
    got = {r.i: r.l for r in df.select("i", magnitude_label("x").alias("l")).collect()}
    assert all(got[i] == label(v) for i, v in enumerate(values))


rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["A", "B", "C", None]),
        st.integers(1995, 1998),
        st.sampled_from(["1", "2", "3", "TOTAL"]),
        st.sampled_from(["x", "y", "z"]),
        st.sampled_from(["c1", "c2", None]),
        st.sampled_from(["Export", "Import", None]),
        st.one_of(st.none(), st.integers(-5, 5)),
    ),
    min_size=0,
    max_size=40,
)


def _sum(vals):
    vals = [v for v in vals if v is not None]
    return sum(vals) if vals else None


def _groups(data, key):
    out = {}
    for r in data:
        out.setdefault(key(r), []).append(r)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=rows_strategy)
def test_reports_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)

    # top_with_ties: rows equal to their (country, flow) max, ties kept, all-null groups dropped
    kept = [r for r in data if r[2] != "TOTAL"]
    expected = []
    for rs in _groups(kept, lambda r: (r[0], r[5])).values():
        mx = max((r[6] for r in rs if r[6] is not None), default=None)
        expected += [r for r in rs if mx is not None and r[6] == mx]
    got = top_with_ties(df, exclude={"comm_code": "TOTAL"}, label=False).drop("biggest_trade").collect()
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got)

    # period_totals: one row per (country, flow, year)
    exp = {k: _sum(r[6] for r in rs) for k, rs in _groups(data, lambda r: (r[0], r[5], r[1])).items()}
    got = {(r.country_or_area, r.flow, r.year): r.overall_sum for r in period_totals(df).collect()}
    assert got == exp

    # leader_in_group over categories other than null (the <> filter drops null)
    per_item = {
        k: _sum(r[6] for r in rs) for k, rs in _groups([r for r in data if r[4] is not None], lambda r: (r[3], r[4], r[5])).items()
    }
    leaders = set()
    for (cat, flow), items in _groups(list(per_item.items()), lambda kv: (kv[0][1], kv[0][2])).items():
        top = max((s for _, s in items if s is not None), default=None)
        total = _sum(s for _, s in items)
        leaders |= {(k[0], flow, cat, total, s) for k, s in items if top is not None and s == top}
    got = leader_in_group(df, exclude={"category": "__none__"}, label=False).collect()
    assert {tuple(r) for r in got} == leaders

    # balance_by_period: years with both sides and a non-null saldo
    exp_bp = set()
    for (c, y), rs in _groups([r for r in data if r[5] in ("Export", "Import")], lambda r: (r[0], r[1])).items():
        e = _sum(r[6] for r in rs if r[5] == "Export")
        i = _sum(r[6] for r in rs if r[5] == "Import")
        if e is not None and i is not None:
            exp_bp.add((c, y, e, i, e - i))
    got = balance_by_period(df).select("country_or_area", "year", "export_total", "import_total", "saldo").collect()
    assert {tuple(r) for r in got} == exp_bp

    # balance since 1996: keys with at least one row on each side
    exp_b = set()
    recent = [r for r in data if r[1] >= 1996 and r[5] in ("Export", "Import") and r[0] is not None]
    for c, rs in _groups(recent, lambda r: r[0]).items():
        ex = [r for r in rs if r[5] == "Export"]
        im = [r for r in rs if r[5] == "Import"]
        if ex and im:
            e, i = _sum(r[6] for r in ex), _sum(r[6] for r in im)
            exp_b.add((c, e, i, None if e is None or i is None else e - i))
    got = balance(df, 1996).select("country_or_area", "overall_export", "overall_import", "saldo").collect()
    assert {tuple(r) for r in got} == exp_b
