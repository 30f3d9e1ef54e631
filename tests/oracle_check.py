"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Checks row count, column names (sorted) and an order-insensitive hash of
the values, normalizing floats (6 decimals), timestamps and lists.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "tolist"):
        return norm(v.tolist())
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck_connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, sf_dir, query, sql):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res["duck_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    hs, ls = digest(s_cols, s_rows)
    hd, ld = digest(d_cols, d_rows)
    res["hash_match"] = hs == hd
    res["status"] = "ok" if (res["cols_match"] and hs == hd and len(s_rows) == len(d_rows)) else "FAIL"
    if res["status"] == "FAIL":
        res["spark_cols"], res["duck_cols"] = sorted(s_cols), sorted(d_cols)
        only_s = sorted(set(ls) - set(ld))[:3]
        only_d = sorted(set(ld) - set(ls))[:3]
        res["only_spark"], res["only_duck"] = only_s, only_d
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from jobtide.session import get_spark
    import __spark_entry__ as E
    spark = get_spark("oracle-check", master="local[8]",
                      extra_conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck_connect(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        try:
            r = compare(spark, con, name, sf_dir, qs[name], sqls.get(name))
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": str(e).splitlines()[0][:300]}
        bad += r["status"] in ("FAIL", "ERROR")
        print(r, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
