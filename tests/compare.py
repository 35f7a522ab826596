"""Compares every named query with its SQL.

Run as ``python tests/compare.py [scale] [name ...]``; also used by the tests.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'"
        )
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return repr(float(value))
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql) -> str | None:
    """None if both give the same rows, else what differs."""
    cursor = connection.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = _rows(expected_names, cursor.fetchall())
    actual = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(spark_df.columns) != sorted(expected_names):
        return f"columns {sorted(spark_df.columns)} != {sorted(expected_names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from conftest import make_session

    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{scale}"
    spark = make_session()
    connection = duck(sf_dir)
    oracle = entry.oracle_sql()
    unknown = sorted(set(oracle) - set(entry.queries()))
    print("oracle without query:", unknown)
    failed = []
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in oracle:
                found = difference(query(spark, sf_dir), connection, oracle[name])
            else:
                found = None if query(spark, sf_dir).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql " if name in oracle else "rows"
        print(f"{time.time() - start:6.2f}s {kind} {name}: {found or 'ok'}", flush=True)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
