"""Run registered queries in Spark and their SQL twins in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: column names (sorted), row count, and the multiset of rows with
doubles rounded to 6 dp.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~null",)
        if math.isinf(v):
            return ("inf", v > 0)
        return round(v, 5) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(None if (x is not None and not isinstance(x, str) and _isna(x)) else x)
                         for x in rec))
    return cols, sorted(out, key=repr)


def _isna(x):
    try:
        import pandas as pd
        r = pd.isna(x)
        return bool(r) if not hasattr(r, "__len__") else False
    except Exception:
        return False


def compare(spark, name: str, sf_dir: str, con=None, verbose=True) -> tuple[bool, str]:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    s_pdf = queries()[name](spark, sf_dir).toPandas()
    t1 = time.time()
    sql = oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: rows-only ({len(s_pdf)} rows, {t1 - t0:.1f}s)"
    d_pdf = con.execute(sql).df()
    sc, sr = rows_of(s_pdf)
    dc, dr = rows_of(d_pdf)
    if sc != dc:
        return False, f"{name}: columns differ spark={sc} duck={dc}"
    kinds = [(c, s_pdf[c].dtype.kind, d_pdf[c].dtype.kind) for c in sc
             if s_pdf[c].dtype.kind != d_pdf[c].dtype.kind and len(s_pdf) and len(d_pdf)]
    if kinds:
        return False, f"{name}: column kinds differ {kinds}"
    if len(sr) != len(dr):
        return False, f"{name}: rows differ spark={len(sr)} duck={len(dr)}"
    bad = [(a, b) for a, b in zip(sr, dr) if a != b]
    if bad:
        return False, f"{name}: {len(bad)} row mismatches, e.g. spark={bad[0][0]} duck={bad[0][1]}"
    return True, f"{name}: OK {len(sr)} rows ({t1 - t0:.1f}s)"


def main():
    sys.path.insert(0, ".")
    from riskgrid.session import get_spark
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark(shuffle_partitions=8)
    from __spark_entry__ import queries
    con = duck(sf_dir)
    ok_all = True
    for n in names or list(queries()):
        try:
            ok, msg = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        ok_all &= ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
