"""Run Spark queries and their oracle SQL side by side (as the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.md5("\n".join(keyed).encode()).hexdigest(), [cols[i] for i in order]


def compare(spark, sf_dir, names=None):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            ts = time.time() - t0
        except Exception as e:  # noqa: BLE001
            out[name] = ("SPARK-ERROR", str(e)[:400])
            print(name, "SPARK-ERROR", str(e)[:400], flush=True)
            continue
        if name not in sql:
            out[name] = ("rows-only", len(rows))
            print(f"{name:34s} rows-only n={len(rows)} spark={ts:.1f}s", flush=True)
            continue
        t1 = time.time()
        try:
            res = con.execute(sql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            out[name] = ("SQL-ERROR", str(e)[:400])
            print(name, "SQL-ERROR", str(e)[:400], flush=True)
            continue
        to = time.time() - t1
        h1, c1 = digest(cols, rows)
        h2, c2 = digest(ocols, orows)
        ok = h1 == h2 and c1 == c2 and len(rows) == len(orows)
        out[name] = ("OK" if ok else "MISMATCH", len(rows), len(orows))
        print(f"{name:34s} {'OK' if ok else 'MISMATCH'} n={len(rows)}/{len(orows)} "
              f"spark={ts:.1f}s sql={to:.1f}s" + ("" if c1 == c2 else f" cols {c1} vs {c2}"), flush=True)
        if not ok and c1 == c2:
            order = sorted(range(len(cols)), key=lambda i: cols[i])
            a = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
            oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
            b = sorted(repr(tuple(norm(r[i]) for i in oorder)) for r in orows)
            sa, sb = set(a), set(b)
            print("   spark-only:", sorted(sa - sb)[:3])
            print("   sql-only:  ", sorted(sb - sa)[:3])
    return out


if __name__ == "__main__":
    from riskframe.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8, driver_memory="16g")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print("BAD:", bad)
