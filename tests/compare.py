"""Run the queries against their SQL in DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(value):
    if isinstance(value, float):
        return repr(value)
    return value if value is None else str(value)


def rows_of(columns: list[str], rows: list) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    listed = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(listed, key=lambda r: [(v is not None, v or "") for v in r])


def difference(spark, connection, sf_dir: str, name: str) -> str | None:
    """None when both agree, else what differs."""
    df = entry_points.queries()[name](spark, sf_dir)
    columns, ours = rows_of(df.columns, df.collect())
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return None
    cursor = connection.execute(sql)
    sql_columns = [c[0] for c in cursor.description]
    types = dict(zip(sql_columns, [str(c[1]) for c in cursor.description]))
    sql_columns, theirs = rows_of(sql_columns, cursor.fetchall())
    if columns != sql_columns:
        return f"columns {columns} / {sql_columns}"
    if ours == theirs:
        kinds = {"string": ("VARCHAR", "STRING"), "bigint": ("BIGINT", "NUMBER"), "int": ("INTEGER", "NUMBER")}
        wrong = [(c, t, types[c]) for c, t in df.dtypes if t in kinds and types[c] not in kinds[t]]
        return f"types {wrong}" if wrong else None
    ours_only = [r for r in ours if r not in set(theirs)][:3]
    theirs_only = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} / {len(theirs)} rows; {columns}; only ours {ours_only}; only SQL {theirs_only}"


def main() -> None:
    from tests.sessions import local_session

    arguments = sys.argv[1:]
    sf_dir = arguments.pop(0) if arguments and arguments[0].startswith("/") else "/root/testdata/sf0.01"
    spark, connection = local_session(), connect(sf_dir)
    bad = 0
    for name in arguments or entry_points.queries():
        started = time.time()
        try:
            found = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = f"{type(error).__name__}: {str(error)[:600]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - started:.1f}s {found or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
