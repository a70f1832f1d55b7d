"""Run registered queries in Spark and their oracle SQL in DuckDB, compare like the driver does:
row count, column names, and an order-insensitive hash of the values (columns sorted by name).

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import json
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return repr(v.tolist())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order]) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report, keep going
            report[name] = {"ok": False, "error": f"spark: {exc}"[:400]}
            continue
        t1 = time.time()
        if name not in sqls:
            report[name] = {"ok": None, "rows": len(s_rows), "note": "no oracle"}
            continue
        try:
            res = con.sql(sqls[name])
            d_cols = res.columns
            d_rows = res.fetchall()
        except Exception as exc:
            report[name] = {"ok": False, "error": f"duckdb: {exc}"[:400]}
            continue
        same_cols = sorted(s_cols) == sorted(d_cols)
        same_n = len(s_rows) == len(d_rows)
        same_hash = same_cols and digest(s_cols, s_rows) == digest(d_cols, d_rows)
        report[name] = {"ok": same_cols and same_n and same_hash, "rows": [len(s_rows), len(d_rows)],
                        "cols": same_cols, "hash": same_hash, "spark_sec": round(t1 - t0, 2)}
        if verbose:
            print(name, report[name], flush=True)
            if not same_cols:
                print("  spark:", sorted(s_cols), "\n  duck: ", sorted(d_cols))
    return report


if __name__ == "__main__":
    from tidemark.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session()
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print(json.dumps({"total": len(rep), "failed": bad}))
