"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare the results.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
The comparison sorts columns by name and rows by value, as the driver's check does.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playlens.sources.tables import TEST_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TEST_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        # Exact: the driver hashes values, so even last-bit differences must show up here.
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, key: str, build, sql: str | None, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = build(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"key": key, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2), "schema": str(sdf.schema.simpleString())}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    res["duck_sec"] = round(time.time() - t0, 2)
    if sorted(s_cols) != sorted(d_cols):
        res["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
        return res
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a == b:
        res["status"] = "match"
    else:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["status"] = f"MISMATCH rows {len(a)} vs {len(b)}; first diffs {diff}"
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as entry
    from playlens.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        try:
            r = compare(spark, con, key, qs[key], sqls.get(key), sf_dir)
        except Exception as e:  # report and continue
            r = {"key": key, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
