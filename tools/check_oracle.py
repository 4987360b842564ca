"""Run registered queries against their DuckDB oracles and report matches.

Usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v, digits=9):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.{digits}g}")
    if isinstance(v, Decimal):
        return float(f"{float(v):.{digits}g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    if hasattr(v, "asDict"):
        return norm(v.asDict(), digits)
    return v


def rows_of(cols, rows, digits):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i], digits) for i in order) for r in rows)


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in args if not a.startswith("/")]
    from citylens.session import build_session
    from citylens.catalog import ORACLES, QUERIES
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for key in keys or sorted(QUERIES):
        t0 = time.time()
        try:
            df = QUERIES[key](spark, sf)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-SPARK {key}: {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if key not in ORACLES:
            print(f"ROWS-ONLY {key}: rows={len(s_rows)} ({ts:.1f}s)")
            continue
        try:
            res = con.execute(ORACLES[key])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL-DUCK {key}: {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(s_cols) != sorted(d_cols):
            print(f"COLS {key}: spark={sorted(s_cols)} duck={sorted(d_cols)}")
            bad += 1
            continue
        exact = rows_of(s_cols, s_rows, 17) == rows_of(d_cols, d_rows, 17)
        close = rows_of(s_cols, s_rows, 9) == rows_of(d_cols, d_rows, 9)
        tag = "OK" if exact else ("CLOSE" if close else "DIFF")
        print(f"{tag} {key}: spark={len(s_rows)} duck={len(d_rows)} ({ts:.1f}s)")
        if not close:
            bad += 1
            a, b = rows_of(s_cols, s_rows, 9), rows_of(d_cols, d_rows, 9)
            print("   cols:", sorted(s_cols))
            print("   spark-only:", list((a - b).items())[:3])
            print("   duck-only:", list((b - a).items())[:3])
    print(f"bad={bad}")


if __name__ == "__main__":
    main()
