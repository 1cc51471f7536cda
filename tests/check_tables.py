"""Compare registered queries with their SQL in DuckDB.

    python tests/check_tables.py [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def table_of(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def spark_side(spark, query, folder):
    frame = query(spark, folder)
    return table_of(frame.columns, frame.collect())


def sql_side(connection, sql):
    result = connection.execute(sql)
    return table_of([column[0] for column in result.description], result.fetchall())


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from meterline.session import build_session

    arguments = sys.argv[1:]
    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(oracle_sql())
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("OFF")
    connection = open_tables(folder)
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            got = spark_side(spark, queries()[name], folder)
            expected = sql_side(connection, oracle_sql()[name])
            verdict = "equal" if got == expected else "DIFFERENT"
            spent = time.time() - started
            print(f"{verdict:10} {name:36} {len(got[1]):7} rows {spent:6.2f} s", flush=True)
            if got != expected:
                bad += 1
                print("  columns", got[0], expected[0], "rows", len(got[1]), len(expected[1]))
                for a, b in [(a, b) for a, b in zip(got[1], expected[1]) if a != b][:3]:
                    print("   ", a, "\n   ", b)
        except Exception:
            bad += 1
            print(f"FAILED     {name}\n{traceback.format_exc(limit=-3)[:1200]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
