"""Run every registered query next to its SQL and compare the rows.

    python tests/check_oracles.py [sf] [name,name,...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from clipframe.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns differ: {got[0]} / {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"row counts differ: {len(got[1])} / {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w or [type(x) for x in g] != [
        type(x) for x in w]]
    return f"{len(bad)} of {len(want[1])} rows differ, first: {bad[0]}" if bad else ""


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2].split(",") if len(sys.argv) > 2 else list(entry.oracle_sql())
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as exc:
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s {problem}",
              flush=True)
    print(f"{len(names) - failed} of {len(names)} match")
    return failed


if __name__ == "__main__":
    sys.exit(main())
