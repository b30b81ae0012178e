"""Runs registered queries against their SQL: python tests/oracle_check.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    return "null" if v is None else str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name):
    """(spark rows, sql rows, difference or None)"""
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got[1]), None, None
    rel = con.sql(sql)
    want = canonical(rel.columns, rel.fetchall())
    if got == want:
        return len(got[1]), len(want[1]), None
    if got[0] != want[0]:
        return len(got[1]), len(want[1]), f"columns {got[0]} / {want[0]}"
    a, b = set(got[1]), set(want[1])
    return len(got[1]), len(want[1]), f"only spark {sorted(a - b)[:3]} only sql {sorted(b - a)[:3]}"


def main():
    from tessera.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session(
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    for name in names:
        t = time.time()
        try:
            n, m, diff = compare(spark, con, sf_dir, name)
            verdict = "no sql" if m is None else ("ok" if diff is None else f"DIFF {diff}")
            print(f"{name}: {n} / {m} {verdict} {time.time() - t:.1f}s", flush=True)
        except Exception as e:  # keep going: the list is the report
            print(f"{name}: ERROR {type(e).__name__} {str(e)[:700]}", flush=True)


if __name__ == "__main__":
    main()
