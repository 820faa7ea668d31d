"""Run registered queries against their DuckDB counterparts.

    python tests/compare.py <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def rows_of(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_value(row[i]) for i in order) for row in rows), key=_sortable
    )


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())


def difference(left, right) -> str | None:
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from outbreaklens.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    oracles = entry.oracle_sql()
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        begin = time.time()
        try:
            mine = spark_rows(run(spark, folder))
            took, begin = time.time() - begin, time.time()
            theirs = duck_rows(connection, oracles[name]) if name in oracles else None
            verdict = "rows only" if theirs is None else (difference(mine, theirs) or "equal")
        except Exception as error:  # report and go on with the next query
            print(f"{name:28} FAILED {type(error).__name__}: {str(error)[:600]}", flush=True)
            continue
        print(f"{name:28} {len(mine[1]):7} rows {took:6.1f}s duck {time.time() - begin:5.1f}s {verdict}", flush=True)
