"""Run registered queries on Spark and their oracle SQL on DuckDB over the
same parquet tables and compare row count, column names and values
(order-insensitive). Usable as a script: ``python tests/oracle_compare.py
[sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits):
    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.date() if v == v.normalize() else v.to_pydatetime()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, digits) if digits is not None else v
    if hasattr(v, "item"):
        v = v.item()
        return _norm(v, digits)
    if isinstance(v, (pd.Timestamp,)):
        return v.date()
    return v


def rows_of(df: pd.DataFrame, digits=None):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    ddf = con.execute(sql).fetchdf()
    res = {"name": name, "spark_rows": len(sdf), "duck_rows": len(ddf), "spark_sec": round(t1 - t0, 2)}
    cs, rs = rows_of(sdf)
    cd, rd = rows_of(ddf)
    res["cols_match"] = cs == cd
    if cs != cd:
        res["cols"] = (cs, cd)
    res["exact"] = rs == rd
    if not res["exact"]:
        _, rs9 = rows_of(sdf, 9)
        _, rd9 = rows_of(ddf, 9)
        res["approx9"] = rs9 == rd9
        if not res["approx9"]:
            diff = [(a, b) for a, b in zip(rs9, rd9) if a != b][:3]
            res["diff"] = diff
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from parcelflow.plans import catalog
    from parcelflow.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.queries())
    spark = local_session(8)
    con = duck(sf_dir)
    qs, os_ = catalog.queries(), catalog.oracle_sql()
    bad = 0
    for n in names:
        if n not in os_:
            r = qs[n](spark, sf_dir).count()
            print(f"{n:28s} rows-only {r}")
            continue
        try:
            r = compare(spark, con, n, qs[n], os_[n], sf_dir)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{n:28s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        ok = r["cols_match"] and r["spark_rows"] == r["duck_rows"] and r["exact"]
        bad += not ok
        print(f"{n:28s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['duck_rows']} "
              f"t={r['spark_sec']}s" + ("" if ok else f" {({k: v for k, v in r.items() if k in ('cols', 'approx9', 'diff')})}"))
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
