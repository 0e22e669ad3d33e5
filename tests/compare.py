"""Run registered queries against DuckDB: `python tests/compare.py [sf_dir] [name part ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def database(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value) if not isinstance(value, (int, str, bool)) else value


def kind(value):
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def check(spark, con, name, sf_dir, queries, oracles):
    start = time.time()
    df = queries[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in oracles:
        return f"ran only, no SQL: {len(got)} rows", took, bool(df.columns)
    con.execute(oracles[name])
    names = [d[0] for d in con.description]
    want = con.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", took, False
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return f"{len(a)} rows", took, bool(a)
    only_a, only_b = sorted(set(a) - set(b), key=str)[:1], sorted(set(b) - set(a), key=str)[:1]
    cells = [(n, x, y) for p, q in zip(only_a, only_b) for n, x, y in zip(sorted(names), p, q) if x != y]
    return f"{len(a)} vs {len(b)} rows; first differing cells {str(cells)[:1500]}", took, False


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from rollmatch.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, qs, sqls = database(sf), queries(), oracle_sql()
    failed = []
    for n in qs:
        if parts and not any(p in n for p in parts):
            continue
        try:
            message, took, good = check(spark, con, n, sf, qs, sqls)
        except Exception as e:  # noqa: BLE001
            message, took, good = f"{type(e).__name__}: {str(e)[:1200]}", 0.0, False
        print("ok  " if good else "FAIL", n, f"{took:.2f}s", message, flush=True)
        if not good:
            failed.append(n)
    print("failed:", failed)
