"""Compare every registered query with its SQL on the given tables.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat()
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def check(spark, con, sf_dir, name, query, sql):
    """None when equal, else a description of the first difference."""
    df = query(spark, sf_dir)
    got_cols, got = df.columns, df.collect()
    if sql is None:
        return None if got else "no rows"
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    if sorted(got_cols) != sorted(want_cols):
        return f"columns {sorted(got_cols)} != {sorted(want_cols)}"
    a, b = rows_of(got_cols, got), rows_of(want_cols, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            bad = sum(1 for p, q in zip(a, b) if p != q)
            return f"{bad} of {len(a)} rows differ, first: {sorted(got_cols)} spark {x} sql {y}"
    return None if a else "equal but empty"


def main():
    from climaflow.session import local_session
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(int(os.environ.get("COMPARE_CORES", "8"))), duck(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in args or queries:
        start = time.time()
        try:
            problem = check(spark, con, sf_dir, name, queries[name], sql.get(name))
        except Exception as ex:  # keep going: one line per query
            problem = f"{type(ex).__name__}: {str(ex)[:600]}"
        kind = "sql " if name in sql else "rows"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print("failed", failed)
    spark.stop()


if __name__ == "__main__":
    main()
