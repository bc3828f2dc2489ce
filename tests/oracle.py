"""Compare registered queries with their SQL run by DuckDB.

As a script: python tests/oracle.py FOLDER [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        values = frame[column]
        if values.dtype.kind == "M":
            frame[column] = values.astype("datetime64[us]").astype(str)
        elif values.dtype == object:
            frame[column] = values.map(lambda v: None if v is None or v is pd.NaT or v != v else str(v))
    ordered = frame.sort_values(list(frame.columns), ignore_index=True, na_position="last")
    return ordered


def differences(actual: pd.DataFrame, expected: pd.DataFrame) -> str | None:
    """None if both hold the same rows, else a short description."""
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} / {sorted(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} / {len(expected)}"
    left, right = _plain(actual), _plain(expected)
    for column in left.columns:
        a, b = left[column], right[column]
        if {a.dtype.kind, b.dtype.kind} == {"i", "f"} and (a.isna().any() or b.isna().any()):
            pass  # an integer column with NULLs is a float on one side
        elif a.dtype.kind != b.dtype.kind and len(a):
            return f"{column}: type {a.dtype} / {b.dtype}"
        same = (a == b) | (a.isna() & b.isna())
        if not same.all():
            where = (~same).idxmax()
            return f"{column}: {(~same).sum()} differ, e.g. {a[where]!r} / {b[where]!r}"
    return None


def main(folder: str, names: list[str]) -> int:
    from igarape.queries import QUERIES, SQL
    from igarape.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            actual = QUERIES[name](spark, folder).toPandas()
            took = time.time() - started
            if name in SQL:
                problem = differences(actual, connection.sql(SQL[name]).df())
            else:
                problem = None if len(actual) else "no rows"
            kind = "sql" if name in SQL else "rows"
        except Exception as error:  # report and go on
            took, problem, kind = time.time() - started, f"{type(error).__name__}: {str(error)[:600]}", "error"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {kind:5} {took:6.2f}s {name} {problem or len(actual)}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
