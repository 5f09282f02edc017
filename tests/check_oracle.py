"""Run every registered query against its SQL in DuckDB; print differences.

    python tests/check_oracle.py [folder] [name...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from scorecard.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(value):
    return ("", "") if value is None else (type(value).__name__, str(value))


def _ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(_cell(r[i]) for i in at) for r in rows)


def compare(spark, con, folder: str, name: str, query, sql: str) -> tuple[str | None, int, float]:
    """A description of the difference or None, the row count, the Spark seconds."""
    started = time.time()
    df = query(spark, folder)
    columns = df.columns
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - started
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    gc, gr = _ordered(columns, got)
    ec, er = _ordered(expected_columns, expected)
    if gc != ec:
        return f"columns {gc} vs {ec}", len(got), seconds
    if gr != er:
        only = [r for r in gr if r not in set(er)][:2]
        other = [r for r in er if r not in set(gr)][:2]
        return f"{len(gr)} vs {len(er)} rows; spark only {only}; sql only {other}", len(got), seconds
    return None, len(got), seconds


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = local_session(), connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if names and name not in names:
            continue
        if name not in oracle:
            print(f"----  {name}: no SQL")
            continue
        try:
            problem, rows, seconds = compare(spark, con, folder, name, query, oracle[name])
        except Exception as e:  # noqa: BLE001
            problem, rows, seconds = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '}  {name:45s} {rows:7d} rows {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} differ; without query: {sorted(set(oracle) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(main())
