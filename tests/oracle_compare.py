"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of values
(floats rounded), the way the round driver does.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    import datetime as dt
    import decimal

    import pandas as pd

    if v is None:
        return "NULL"
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "NULL"
        return f"{round(f, 6):.6f}"
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, dt.date):
        return pd.Timestamp(v).strftime("%Y-%m-%d %H:%M:%S.%f")
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    if isinstance(v, (bool,)):
        return str(int(v))
    return str(v)


def digest(pdf) -> tuple[int, list[str], str]:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for _, r in pdf[cols].iterrows())
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
            t1 = time.time()
            s = digest(sp)
            if name in sql:
                d = digest(con.sql(sql[name]).df())
                ok = s == d
                detail = "" if ok else f"spark={s[0]} rows {s[1]} duck={d[0]} rows {d[1]}"
            else:
                ok, detail = None, f"rows-only: {s[0]}"
            results[name] = ok
            if verbose:
                print(f"{name:38s} {str(ok):5s} rows={s[0]:<7d} {t1 - t0:6.2f}s {detail}", flush=True)
        except Exception as exc:  # report and continue
            results[name] = False
            if verbose:
                print(f"{name:38s} ERROR {type(exc).__name__}: {str(exc)[:400]}", flush=True)
    return results


if __name__ == "__main__":
    from lakestrata.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v is False]
    print("FAILED:", bad if bad else "none")
