"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) else value
    if hasattr(value, "as_tuple"):
        return _plain(float(value))
    return value


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=lambda row: [(v is None, str(v)) for v in row]
    )


def spark_result(df):
    return _normal(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(connection, sql):
    cursor = connection.execute(sql)
    return _normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        extra = list(set(left[1]) - set(right[1]))[:3], list(set(right[1]) - set(left[1]))[:3]
        return f"rows {len(left[1])} != {len(right[1])}: {extra}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{len(wrong)} of {len(left[1])} rows differ, first {wrong[:3]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> int:
    from delaynet.plans.catalog import ORACLES, QUERIES
    from delaynet.session import build_session

    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failures = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            got = spark_result(QUERIES[name](spark, sf_dir))
            took = time.time() - started
            if name in ORACLES:
                started = time.time()
                expected = oracle_result(connection, ORACLES[name])
                problem = difference(got, expected)
                print(f"{'FAIL' if problem else 'ok  '} {name:28} rows={len(got[1]):7} spark={took:6.2f}s duckdb={time.time() - started:6.2f}s {problem or ''}", flush=True)
                failures += bool(problem)
            else:
                print(f"rows {name:28} rows={len(got[1]):7} spark={took:6.2f}s {got[1][:2]}", flush=True)
        except Exception as error:  # report and go on with the next query
            failures += 1
            print(f"FAIL {name:28} {type(error).__name__}: {str(error)[:600]}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
