"""Run registered Spark queries and their DuckDB SQL twins side by side.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: rows spark/duckdb, column match, value match.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{digits}g}")
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    return v


def rows_of(cols, records, digits=9):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i], digits) for i in order) for r in records)


def compare(spark, con, name, fn, sql, sf_dir, digits=9):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, spark_rows=len(s_rows), sec=round(t1 - t0, 2), oracle=False)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    same_cols = sorted(s_cols) == sorted(d_cols)
    exact = same_cols and rows_of(s_cols, s_rows, 17) == rows_of(d_cols, d_rows, 17)
    close = same_cols and rows_of(s_cols, s_rows, digits) == rows_of(d_cols, d_rows, digits)
    out = dict(name=name, spark_rows=len(s_rows), duck_rows=len(d_rows), cols=same_cols, exact=exact,
               close=close, sec=round(t1 - t0, 2))
    if not same_cols:
        out["spark_cols"] = sorted(s_cols)
        out["duck_cols"] = sorted(d_cols)
    elif not close:
        a, b = rows_of(s_cols, s_rows, digits), rows_of(d_cols, d_rows, digits)
        out["only_spark"] = list((a - b).items())[:3]
        out["only_duck"] = list((b - a).items())[:3]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    from servelens.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if keys and name not in keys:
            continue
        try:
            r = compare(spark, con, name, fn, sq.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = dict(name=name, error=repr(e)[:400])
        ok = r.get("exact") or r.get("close") or (r.get("oracle") is False and "error" not in r)
        bad += 0 if ok else 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
