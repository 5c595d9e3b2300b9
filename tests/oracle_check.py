"""Run registered queries in Spark and their SQL oracles in DuckDB, compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Prints one line per query and a summary; exit code 1 on any mismatch.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return f"row count spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"first differing row:\n  spark={x}\n  duck ={y}"
    return None


def run(sf_dir: str, names=None, spark=None) -> dict[str, str | None]:
    from tessera import plans
    from tessera.session import build_session

    spark = spark or build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    con = duck(sf_dir)
    out = {}
    for name in names or sorted(plans.QUERIES):
        t = time.time()
        try:
            df = plans.QUERIES[name](spark, sf_dir)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
            if name not in plans.ORACLE:
                out[name] = None
                print(f"{name:28s} ROWS-ONLY n={len(rows)} {time.time() - t:.1f}s", flush=True)
                continue
            res = con.execute(plans.ORACLE[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            err = compare(rows, cols, drows, dcols)
        except Exception as e:  # noqa: BLE001
            err = f"error: {type(e).__name__}: {str(e)[:600]}"
        out[name] = err
        print(f"{name:28s} {'OK ' if err is None else 'BAD'} {time.time() - t:.1f}s {err or ''}", flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
    sys.exit(1 if bad else 0)
