"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Rows are compared order-insensitively after sorting columns by name;
doubles are compared at 6 decimals.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
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
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=_key)


def compare(spark, name, fn, sql, sf_dir, con):
    t0 = time.time()
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    sc, sr = normalise(scols, srows)
    dc, dr = normalise(dcols, drows)
    ok = sc == dc and len(sr) == len(dr) and sr == dr
    msg = ""
    if not ok:
        if sc != dc:
            msg = f"columns {sc} vs {dc}"
        elif len(sr) != len(dr):
            msg = f"rows {len(sr)} vs {len(dr)}"
        else:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            msg = f"values differ e.g. {diff}"
    return ok, len(sr), t1 - t0, t2 - t1, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from cartwheel.session import build_session
    import __spark_entry__ as E
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    qs, oq = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in oq:
            df = qs[name](spark, sf_dir)
            n = df.count()
            print(f"{name:32s} rows-only {n}")
            continue
        try:
            ok, n, ts, td, msg = compare(spark, name, qs[name], oq[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, td, msg = False, -1, 0, 0, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} rows={n:<7d} spark={ts:.2f}s duck={td:.2f}s {msg}")
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
