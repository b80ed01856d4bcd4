"""Run every query in Spark and DuckDB and compare the rows.

Usage: python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def rows(columns: list[str], values: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(row[i] for i in order) for row in values]
    return sorted(picked, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark, connection, sf_dir: str, query, sql: str) -> tuple[str | None, int]:
    df = query(spark, sf_dir)
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", 0
    want = rows(columns, result.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None, len(got)
    first = next((p for p in zip(got, want) if p[0] != p[1]), None)
    return f"{len(got)} rows != {len(want)} rows; first difference {str(first)[:800]}", len(got)


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args else "/root/testdata/sf0.01"
    spark = make_session()
    connection = connect(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, query in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem, n = differences(spark, connection, sf_dir, query, oracles[name])
            else:
                problem, n = None, query(spark, sf_dir).count()
        except Exception as error:  # noqa: BLE001 - report and go on with the rest
            problem, n = f"{type(error).__name__}: {str(error)[:1500]}", 0
        kind = "sql" if name in oracles else "rows only"
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.1f}s {n:8} {kind:9} {name} {problem or ''}", flush=True)
        bad += bool(problem)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
