"""Spark-vs-DuckDB comparison of registered queries.

Compares column names, row count and the multiset of rows (order-free).
Run directly: ``python tests/oracle_harness.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def compare(spark, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(_norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    con = duck(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = [tuple(_norm(x) for x in r) for r in cur.fetchall()]
    res["duck_rows"] = len(drows)
    if sorted(cols) != sorted(dcols):
        res["status"] = f"COLUMNS spark-only={sorted(set(cols)-set(dcols))} duck-only={sorted(set(dcols)-set(cols))}"
        return res
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(r[i] for i in si) for r in srows)
    dc = Counter(tuple(r[i] for i in di) for r in drows)
    if sc == dc:
        res["status"] = "MATCH"
    else:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        # locate differing columns on the first mismatching pair
        diff_cols = set()
        for a, b in zip(sorted((sc - dc).elements(), key=str), sorted((dc - sc).elements(), key=str)):
            diff_cols |= {order[k] for k in range(len(order)) if a[k] != b[k]}
            if len(diff_cols) > 8:
                break
        res["status"] = "MISMATCH"
        res["n_spark_only"] = sum((sc - dc).values())
        res["n_duck_only"] = sum((dc - sc).values())
        res["diff_cols"] = sorted(diff_cols)
        res["example_spark"] = dict(zip(order, only_s[0])) if only_s else None
        res["example_duck"] = dict(zip(order, only_d[0])) if only_d else None
    return res


def main(argv):
    from wapspark.session import build_session
    import __spark_entry__ as E
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    ok = True
    for name in (names or list(qs)):
        try:
            r = compare(spark, sf_dir, name, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        ok &= r["status"] in ("MATCH", "rows-only")
        print(r, flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
