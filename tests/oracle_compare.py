"""Run registered queries on Spark and their SQL on DuckDB; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

EXACT = os.environ.get("ORACLE_EXACT", "1") == "1"  # compare doubles bit for bit

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if EXACT else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records], [columns[i] for i in order]


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    s_norm, s_cols = rows_of(sdf.columns, s_rows)
    d_norm, d_cols_sorted = rows_of(d_cols, d_rows)
    same_cols = s_cols == d_cols_sorted
    cs, cd = Counter(s_norm), Counter(d_norm)
    ok = same_cols and cs == cd
    out = {
        "name": name, "ok": ok, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_ok": same_cols, "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2),
    }
    if not same_cols:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols_sorted
    elif not ok:
        out["only_spark"] = list((cs - cd).elements())[:5]
        out["only_oracle"] = list((cd - cs).elements())[:5]
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from cohortflow.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    names = argv[2:] or list(qs)
    bad = 0
    for n in names:
        if n not in sqls:
            t0 = time.time()
            c = qs[n](spark, sf_dir).count()
            print({"name": n, "ok": None, "spark_rows": c, "spark_s": round(time.time() - t0, 2), "oracle": "none"}, flush=True)
            continue
        try:
            r = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as e:  # noqa: BLE001 - report and go on
            r = {"name": n, "ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not r["ok"]
        print(r, flush=True)
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
