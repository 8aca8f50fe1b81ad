"""Run every registered query in Spark and its oracle in DuckDB; compare
row count, column names and an order-insensitive hash of the values.

usage: python tools/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    import datetime
    import decimal
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "nan"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from ledgerhawk.plans import oracle, registry
    from ledgerhawk.config import build_session
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = registry.build(), oracle.build()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        srows = [tuple(r) for r in df.collect()]
        scols = df.columns
        t1 = time.time()
        if k not in sqls:
            print(f"{k:28s} spark={len(srows):6d} (no oracle) {t1-t0:.1f}s")
            continue
        cur = con.execute(sqls[k])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        ok = (sorted(scols) == sorted(ocols) and len(srows) == len(orows)
              and digest(scols, srows) == digest(ocols, orows))
        bad += not ok
        print(f"{k:28s} spark={len(srows):6d} duck={len(orows):6d} {'OK ' if ok else 'BAD'} {t1-t0:.1f}s"
              + ("" if sorted(scols) == sorted(ocols) else f" cols {scols} vs {ocols}"))
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
