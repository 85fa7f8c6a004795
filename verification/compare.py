"""Run queries and oracles side by side: python -m verification.compare FOLDER [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from verification.oracles import ORACLES
from verification.queries import QUERIES


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(df.columns)), key=df.columns.__getitem__)
    rows = sorted((tuple(repr(r[i]) for i in order) for r in df.collect()))
    return [df.columns[i] for i in order], rows


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = sorted((tuple(repr(r[i]) for i in order) for r in result.fetchall()))
    return [names[i] for i in order], rows


def main(folder: str, names: list[str]) -> int:
    from bench import session

    spark = session()
    connection = oracle_connection(folder)
    failed = 0
    for name in names or list(QUERIES):
        began = time.time()
        try:
            columns, rows = spark_rows(QUERIES[name](spark, folder))
        except Exception as error:  # noqa: BLE001 - report and go on
            print(f"{name:28s} SPARK ERROR {str(error)[:600]}", flush=True)
            failed += 1
            continue
        took = time.time() - began
        if name not in ORACLES:
            print(f"{name:28s} rows only {len(rows)} {took:.1f}s")
            continue
        try:
            wanted_columns, wanted = oracle_rows(connection, ORACLES[name])
        except Exception as error:  # noqa: BLE001
            print(f"{name:28s} ORACLE ERROR {str(error)[:600]}", flush=True)
            failed += 1
            continue
        same = columns == wanted_columns and rows == wanted
        failed += not same
        print(f"{name:28s} {'ok' if same else 'DIFFERENT'} {len(rows)} rows {took:.1f}s", flush=True)
        if not same:
            print("  spark ", columns, len(rows), [r for r in rows if r not in set(wanted)][:3])
            print("  oracle", wanted_columns, len(wanted), [r for r in wanted if r not in set(rows)][:3])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
