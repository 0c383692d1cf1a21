"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")
from arbiter.adapters import TABLES  # noqa: E402
from arbiter.plans.catalog import ORACLE_SQL, QUERIES  # noqa: E402
from arbiter.session import get_spark  # noqa: E402


def canon(v, approx):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        if approx:
            return f"{v:.9g}"
        return repr(float(v))
    if hasattr(v, "item"):
        return canon(v.item(), approx)
    return str(v)


def digest(df: pd.DataFrame, approx=False):
    cols = sorted(df.columns)
    rows = sorted("|".join(canon(r[c], approx) for c in cols) for r in df.to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()[:12], rows


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_spark()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sdf = QUERIES[n](spark, sf)
            pdf = pd.DataFrame(sdf.collect(), columns=sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLE_SQL.get(n)
        if sql is None:
            print(f"{n:28s} rows={len(pdf):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            odf = con.execute(sql).df()
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} DUCK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(pdf.columns) == sorted(odf.columns)
        h1, r1 = digest(pdf) if same_cols else ("-", [])
        h2, r2 = digest(odf) if same_cols else ("-", [])
        a1, _ = digest(pdf, True) if same_cols else ("-", [])
        a2, _ = digest(odf, True) if same_cols else ("-", [])
        ok = same_cols and len(pdf) == len(odf) and h1 == h2
        status = "OK" if ok else ("APPROX" if same_cols and a1 == a2 else "MISMATCH")
        if not ok:
            bad += 1
        print(f"{n:28s} {status:8s} rows={len(pdf)}/{len(odf)} cols={'ok' if same_cols else (list(pdf.columns), list(odf.columns))} {ts:.1f}s")
        if status == "MISMATCH" and same_cols:
            s1, s2 = set(r1), set(r2)
            for r in sorted(s1 - s2)[:3]:
                print("   spark only:", r[:200])
            for r in sorted(s2 - s1)[:3]:
                print("   duck  only:", r[:200])
    print("bad", bad)


if __name__ == "__main__":
    main()
