"""Run registered queries against their checking SQL: python tools/compare.py <sf_dir> [name ...]

Exact comparison of values after sorting columns by name and rows by value.
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def database(folder: str):
    import duckdb

    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, float):
        return ("f", 0.0 if v == 0 else v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, dt.datetime):
        return ("t", v.isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, folder, name, fn, sql):
    start = time.perf_counter()
    df = fn(spark, folder)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.perf_counter() - start
    if sql is None:
        return True, f"{len(got)} rows, no SQL", took
    start = time.perf_counter()
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want_cols, want = rows_of(cols, cur.fetchall())
    duck = time.perf_counter() - start
    if len(set(got_cols)) != len(got_cols):
        return False, f"duplicate columns {got_cols}", took
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}", took
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}; first {got[:1]} / {want[:1]}", took
    for g, w in zip(got, want):
        if g != w:
            diff = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
            return False, f"{sum(1 for a, b in zip(got, want) if a != b)} rows differ, e.g. {diff[:3]} in {g}"[:900], took
    return True, f"{len(got)} rows (duckdb {duck:.2f}s)", took


def main() -> int:
    from grantlens.catalog import CHECKS, QUERIES
    from grantlens.session import local_session

    folder, names = sys.argv[1], sys.argv[2:]
    names = [k for k in QUERIES if not names or any(k == n or (n.endswith("*") and k.startswith(n[:-1])) for n in names)]
    spark, con = local_session(8), database(folder)
    bad = []
    for name in names:
        try:
            ok, note, took = compare(spark, con, folder, name, QUERIES[name], CHECKS.get(name))
        except Exception as e:  # report and go on
            ok, note, took = False, f"{type(e).__name__}: {str(e)[:700]}", 0.0
        print(f"{'ok  ' if ok else 'BAD '} {name:28s} {took:6.2f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)} of {len(names)} agree; bad: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
