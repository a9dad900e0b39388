"""Run registered queries in Spark and their oracle SQL in DuckDB; compare row count, column
names, exact types and values (order-insensitive, exact; floats also reported with a
relative tolerance so a last-bit difference is told apart from a wrong value).

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def _key(row):
    return tuple((v is None, str(type(v).__name__) if v is not None else "", v if v is not None else 0) for v in row)


# Spark type name -> the DuckDB type the oracle must produce (exact, not by family).
_EXACT = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "smallint": "SMALLINT",
    "tinyint": "TINYINT",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _same_type(spark_type: str, duck_type: str) -> bool:
    return _EXACT.get(spark_type, spark_type.upper()) == duck_type.upper()


def _spark_duck_type_pairs(spark_df, rel):
    s = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    d = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return s, d


def compare(spark, con, name: str, build, oracle: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t_spark = time.time() - t0
    rel = con.sql(oracle)
    s_types, d_types = _spark_duck_type_pairs(sdf, rel)
    drows = [tuple(_norm(v) for v in r) for r in rel.fetchall()]
    res = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows), "spark_sec": round(t_spark, 2)}
    scols, dcols = list(sdf.columns), list(rel.columns)
    res["columns_match"] = sorted(scols) == sorted(dcols)
    if not res["columns_match"]:
        res["columns"] = {"spark": sorted(scols), "oracle": sorted(dcols)}
        res["ok"] = False
        return res
    type_diff = {c: (s_types[c], d_types[c]) for c in scols if not _same_type(s_types[c], d_types[c])}
    res["types_match"] = not type_diff
    if type_diff:
        res["type_diff"] = type_diff
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s_sorted = sorted((tuple(r[i] for i in si) for r in srows), key=_key)
    d_sorted = sorted((tuple(r[i] for i in di) for r in drows), key=_key)
    res["values_exact"] = s_sorted == d_sorted
    if not res["values_exact"] and len(s_sorted) == len(d_sorted):
        diffs = []
        for a, b in zip(s_sorted, d_sorted):
            for c, x, y in zip(order, a, b):
                if x == y:
                    continue
                if isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12):
                    continue
                diffs.append((c, x, y))
        res["values_close"] = not diffs
        res["diff_sample"] = diffs[:5]
    res["ok"] = res["spark_rows"] == res["oracle_rows"] and res["values_exact"] and res["types_match"]
    return res


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from tallyspark.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    q, o = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in o:
            df = q[n](spark, sf_dir)
            print(f"{n:28s} no-oracle rows={df.count()}")
            continue
        try:
            r = compare(spark, con, n, q[n], o[n], sf_dir)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{n:28s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        bad += not r["ok"]
        flag = "OK " if r["ok"] else "BAD"
        extra = {k: v for k, v in r.items() if k not in ("name", "ok", "spark_rows", "oracle_rows", "spark_sec", "columns_match", "types_match", "values_exact")}
        print(f"{n:28s} {flag} rows={r['spark_rows']}/{r['oracle_rows']} {r['spark_sec']}s {extra if extra else ''}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
