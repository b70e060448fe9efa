"""Run queries on Spark and their SQL on DuckDB, and compare the rows.

``python -m checks.compare [folder] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _sorted_rows(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def duckdb_views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both sides give the same rows, else what is different."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    want = _sorted_rows(names, cursor.fetchall())
    got = _sorted_rows(frame.columns, frame.collect())
    if got == want:
        return ""
    only = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"{len(got)} rows against {len(want)}; only here {only[0]}; only there {only[1]}"


def main(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    connection = duckdb_views(sf_dir)
    failed = 0
    for name in names or list(ORACLE):
        start = time.time()
        try:
            problem = differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
        except Exception as error:  # report it and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    from cardwarden.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(local_session(), folder, sys.argv[2:])))
