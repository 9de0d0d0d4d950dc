"""Runs queries against their SQL side by side: ``python -m workload.check SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(x):
    if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return float(x)
    if hasattr(x, "isoformat"):
        return str(pd.Timestamp(x))
    return x


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    """Rows as comparable tuples, columns in name order, in a fixed row order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t),
    )


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), rows_of(columns, cursor.fetchall())


def main(argv: list[str]) -> int:
    from workload.queries import REGISTRY
    from workload.session import local_session
    from workload.sql import oracle_sql

    sf_dir, names = argv[0], argv[1:] or list(REGISTRY)
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name in names:
        started = time.time()
        try:
            got = spark_rows(REGISTRY[name](spark, sf_dir))
            took = time.time() - started
            want = sql_rows(con, sql[name])
        except Exception as error:  # report and go on with the other queries
            bad += 1
            print(f"{name}: FAILED {str(error)[:1500]}", flush=True)
            continue
        if got == want:
            print(f"{name}: ok, {len(got[1])} rows, {took:.1f} s", flush=True)
            continue
        bad += 1
        print(f"{name}: DIFFERENT", got[0], want[0], len(got[1]), len(want[1]))
        a, b = set(got[1]), set(want[1])
        print("   only spark:", list(a - b)[:3], "\n   only sql:", list(b - a)[:3], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
