"""Compare registered Spark queries with their DuckDB SQL.

Mirrors the driver's correctness gate: same row count, same column names,
same multiset of rows (order-insensitive).  Floats are compared after
rounding to 9 significant digits; ``exact`` reports whether they were also
bit-identical.

Run: ``python -m tests.oracle_compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"  # not the same as NULL
        if v == 0 or math.isinf(v):
            return v
        return float(f"{v:.{digits}g}")
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item(), digits)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def _rows(columns, rows, digits):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, query, sql: str | None, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    res["duck_sec"] = round(time.time() - t0, 2)
    res["duck_rows"] = len(d_rows)
    res["columns_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["columns_match"]:
        res["spark_cols"], res["duck_cols"] = s_cols, d_cols
    res["match"] = res["columns_match"] and _rows(s_cols, s_rows, 9) == _rows(d_cols, d_rows, 9)
    res["exact"] = res["columns_match"] and _rows(s_cols, s_rows, 17) == _rows(d_cols, d_rows, 17)
    res["status"] = "ok" if res["match"] else "MISMATCH"
    if not res["match"] and res["columns_match"]:
        a, b = _rows(s_cols, s_rows, 9), _rows(d_cols, d_rows, 9)
        res["only_spark"] = [r for r in a if r not in set(b)][:3]
        res["only_duck"] = [r for r in b if r not in set(a)][:3]
    return res


def main(argv):
    from quarry.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("/")] or list(entry.queries())
    spark = build_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sqls.get(n), sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": "ERROR", "error": repr(e)[:500]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
