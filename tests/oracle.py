"""Compare every query with its SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, run, sql):
    """(problem or None, rows, seconds)."""
    start = time.time()
    df = run(spark, folder)
    got = df.collect()
    took = time.time() - start
    ours = rows_of(df.columns, got)
    cur = con.execute(sql)
    theirs = rows_of([d[0] for d in cur.description], cur.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}", len(got), took
    if ours[1] != theirs[1]:
        a, b = set(map(repr, ours[1])), set(map(repr, theirs[1]))
        return (
            f"rows {len(ours[1])} vs {len(theirs[1])}; only ours {sorted(a - b)[:3]}; "
            f"only sql {sorted(b - a)[:3]}"
        ), len(got), took
    return None, len(got), took


def main() -> int:
    from __spark_entry__ import ALL as REGISTRY
    from grantflow.session import build_session

    args = sys.argv[1:]
    folder = f"/root/testdata/sf{args[0] if args else '0.01'}"
    names = args[1:] or list(REGISTRY)
    spark = build_session(
        "oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name in names:
        q = REGISTRY[name]
        try:
            problem, n, took = compare(spark, con, folder, name, q.run, q.sql)
        except Exception as e:  # keep going, report at the end
            problem, n, took = f"{type(e).__name__}: {str(e)[:600]}", 0, 0.0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {took:.2f}s {problem or ''}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
