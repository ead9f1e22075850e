"""Run registered queries in Spark and their SQL twins in DuckDB; compare like the driver:
row count, column names, and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(names=None, sf="/root/testdata/sf0.01"):
    import duckdb
    import __spark_entry__ as E
    from folio.session import local_session

    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            print(f"{name:28s} spark rows={len(rows)} (no oracle) {t1-t0:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} ORACLE ERROR {e}")
            bad += 1
            continue
        t2 = time.time()
        h1, l1 = digest(df.columns, rows)
        h2, l2 = digest(ocols, orows)
        ok = sorted(df.columns) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        bad += not ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} spark={t1-t0:.1f}s duck={t2-t1:.1f}s")
        if not ok:
            if sorted(df.columns) != sorted(ocols):
                print("   cols", sorted(df.columns), sorted(ocols))
            a, b = set(l1), set(l2)
            for x in sorted(a - b)[:3]:
                print("   spark-only", x[:300])
            for x in sorted(b - a)[:3]:
                print("   duck-only ", x[:300])
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:] or None)
