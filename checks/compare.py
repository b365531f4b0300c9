"""Run queries against their SQL twins in DuckDB: ``python -m checks.compare [folder] [name ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from airq.session import local_session
from checks.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


def differences(spark, con, folder: str, name: str) -> tuple[list[str], int]:
    """Findings (empty when equal) and the number of rows."""
    q = QUERIES[name]
    df = q.run(spark, folder)
    ours = _rows(df.columns, df.collect())
    if q.sql is None:
        return [], len(ours)
    cursor = con.execute(q.oracle())
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    found = []
    if sorted(df.columns) != sorted(names):
        found.append(f"columns {sorted(df.columns)} / {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    if ours != theirs:
        a, b = set(ours), set(theirs)
        found.append(f"only Spark {sorted(a - b)[:3]} only SQL {sorted(b - a)[:3]}, {len(a - b)} / {len(b - a)}")
    return found, len(ours)


def main(folder: str, names: list[str]) -> int:
    spark, con = local_session(), connect(folder)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            found, n = differences(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            found, n = [f"{type(error).__name__}: {str(error)[:1500]}"], -1
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name:30s} {n:7d} rows {time.time() - start:6.2f} s", *found, flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(1 if main(args[0] if args else "/root/testdata/sf0.01", args[1:]) else 0)
