"""Run registered queries in Spark and their SQL in DuckDB and compare names, counts and values.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

from tablewright.plans import inputs, registry


def canonical(value):
    if value is None:
        return ""
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        if math.isnan(value):
            return ""
        return repr(round(value, 9) + 0.0)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in inputs.GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, name, sf_dir, fn, sql):
    """'' if the two sides agree, else what differs."""
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows"
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not got and not want:
        return "both sides are empty"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        return f"rows {len(a)} / {len(b)}; spark only {sorted(left)[:3]}; sql only {sorted(right)[:3]}"
    return ""


def main():
    from tablewright.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    spark, con = local_session(8), duck(sf_dir)
    todo, sqls = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, fn in todo.items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            msg = compare(spark, con, name, sf_dir, fn, sqls.get(name))
        except Exception as e:  # keep going: one report for all queries
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        took = time.time() - start
        if msg or took > 5:
            print(f"{'BAD ' if msg else 'slow'} {name} {took:.1f}s {msg}", flush=True)
        bad += bool(msg)
    print(f"{len(todo)} queries, {len(sqls)} with SQL, {bad} bad")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
