"""Spark-vs-DuckDB comparison of registered queries.

Usage: ``python tests/harness.py [sf_dir] [name ...]``. Prints one line per
query: rows on both sides, column-name equality and value equality
(order-insensitive, floats rounded to 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return (1, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([_norm(x) for x in v]))
    if isinstance(v, dict):
        return (1, repr(sorted((k, _norm(x)) for k, x in v.items())))
    try:
        import numpy as np
        if isinstance(v, np.generic):
            return _norm(v.item())
        if isinstance(v, np.ndarray):
            return _norm(list(v))
    except ImportError:
        pass
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, int):
        return (1, str(v))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return (1, str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


# DuckDB result types as Spark type names.
DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
              "BOOLEAN": "boolean", "SMALLINT": "smallint", "TIMESTAMP": "timestamp", "DATE": "date",
              "FLOAT": "float"}


def type_diffs(spark, sf_dir, name):
    """Columns whose Spark type differs from the oracle's DuckDB type: {col: (spark, duck)}."""
    import __spark_entry__ as E
    st = dict(E.queries()[name](spark, sf_dir).dtypes)
    rel = duck(sf_dir).sql(E.oracle_sql()[name])
    dt = {c: DUCK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    return {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sc, sr = rows_of_spark(qs[name](spark, sf_dir))
            ts = time.time() - t0
            if name not in orc:
                results[name] = dict(rows=len(sr), oracle=None, ok=None, sec=ts)
            else:
                dc, dr = rows_of_duck(con, orc[name])
                ok = sc == dc and sr == dr
                diff = None
                if not ok:
                    a, b = set(sr), set(dr)
                    diff = dict(cols=(sc, dc) if sc != dc else None,
                                only_spark=sorted(a - b)[:3], only_duck=sorted(b - a)[:3])
                results[name] = dict(rows=len(sr), oracle_rows=len(dr), ok=ok, sec=ts, diff=diff)
        except Exception as e:  # report and go on
            results[name] = dict(error=f"{type(e).__name__}: {str(e)[:400]}")
        if verbose:
            print(name, results[name], flush=True)
    return results


if __name__ == "__main__":
    from roadlens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8, extra={"spark.driver.memory": "6g"})
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False or "error" in v]
    print("FAILED:", bad if bad else "none", f"({len(res)} queries)")
