"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None):
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # report and go on
            out[name] = ("spark_error", repr(e)[:400])
            continue
        secs = time.time() - t0
        if name not in sql:
            out[name] = ("rows_only", len(srows), round(secs, 2))
            continue
        try:
            cur = con.execute(sql[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:
            out[name] = ("sql_error", repr(e)[:400])
            continue
        if sorted(scols) != sorted(dcols):
            out[name] = ("columns", scols, dcols)
        elif len(srows) != len(drows):
            out[name] = ("count", len(srows), len(drows))
        elif rows_of(scols, srows) != rows_of(dcols, drows):
            a, b = rows_of(scols, srows), rows_of(dcols, drows)
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            out[name] = ("values", diff)
        else:
            out[name] = ("ok", len(srows), round(secs, 2))
    return out


if __name__ == "__main__":
    from tallyload.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session()
    for k, v in compare(spark, sf, names).items():
        print(k, v, flush=True)
