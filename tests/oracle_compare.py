"""Run a registered query on Spark and its SQL on DuckDB and compare the results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Comparison: same column names, same row count, same multiset of rows (columns sorted by name, doubles
compared after rounding to 6 decimals, timestamps as naive values).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from kinfold.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute(f"SET TimeZone = '{os.environ.get('KINFOLD_DUCK_TZ', 'UTC')}'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> dict:
    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    sql = entry.oracle_sql().get(name)
    out = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    out["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        out["status"] = f"columns differ: spark={sorted(scols)} duck={sorted(dcols)}"
        return out
    a, b = rows_of(scols, srows), rows_of(dcols, drows)
    if a == b:
        out["status"] = "match"
    else:
        only_s = list((a - b).items())[:3]
        only_d = list((b - a).items())[:3]
        out["status"] = f"values differ; spark-only={only_s} duck-only={only_d}"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    from kinfold.session import local_session
    spark = local_session(8, 8)
    spark.conf.set("spark.sql.session.timeZone", os.environ.get("KINFOLD_SPARK_TZ", "UTC"))
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as exc:  # report and continue
            r = {"name": n, "status": f"error: {type(exc).__name__}: {str(exc)[:400]}"}
        ok = r["status"] in ("match", "rows-only")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
