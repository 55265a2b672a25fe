"""Run registered queries against DuckDB: python tests/oracle.py [sf] [name prefix …]."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"f{value!r}"
    if hasattr(value, "as_tuple"):
        return f"d{value}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, sf, fn, sql):
    df = fn(spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, len(got[1]), "rows only"
    res = con.execute(sql)
    want = rows_of([d[0] for d in res.description], res.fetchall())
    if got == want:
        return True, len(got[1]), ""
    if got[0] != want[0]:
        return False, len(got[1]), f"columns {got[0]} != {want[0]}"
    a, b = set(got[1]), set(want[1])
    return False, len(got[1]), f"{len(got[1])} vs {len(want[1])} rows; only spark {sorted(a - b)[:3]}; only oracle {sorted(b - a)[:3]}"


def main():
    from driftwell.plans import all_plans
    from driftwell.session import local_session

    args = sys.argv[1:]
    sf = f"/root/testdata/sf{args[0] if args else '0.01'}"
    spark, con = local_session(), connect(sf)
    bad = 0
    for name, (fn, sql) in all_plans().items():
        if len(args) > 1 and not any(name.startswith(p) for p in args[1:]):
            continue
        t = time.time()
        try:
            ok, n, why = compare(spark, con, sf, fn, sql)
        except Exception as exc:  # noqa: BLE001
            ok, n, why = False, -1, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} rows={n} {time.time() - t:.1f}s {why}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
