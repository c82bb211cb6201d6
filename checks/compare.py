"""Run queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare [--sf DIR] [--cpus N] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb

from checks.expected_sql import EXPECTED_SQL
from checks.query_catalog import QUERIES
from ordersight.plans.shared_store import drop_stored
from ordersight.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(names: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as text, columns by name, sorted: equal lists mean equal results."""
    order = sorted(range(len(names)), key=lambda at: names[at])
    return sorted(tuple(_value(row[at]) for at in order) for row in rows)


def difference(spark, connection, name: str, folder: str) -> str | None:
    df = QUERIES[name](spark, folder)
    mine = rows_of(df.columns, [tuple(row) for row in df.collect()])
    found = connection.execute(EXPECTED_SQL[name])
    columns = [column[0] for column in found.description]
    theirs = rows_of(columns, found.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} against {sorted(columns)}"
    if mine != theirs:
        extra, lacking = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        return f"{len(mine)} rows against {len(theirs)}; extra {extra[:2]}, lacking {lacking[:2]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = build_session(
        "compare",
        f"local[{options.cpus}]",
        spark__sql__shuffle__partitions=os.environ.get("SHUFFLE_PARTITIONS", "8"),
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(options.sf)
    wrong = 0
    for name in options.names or list(QUERIES):
        start = time.time()
        try:
            problem = difference(spark, connection, name, options.sf)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    drop_stored(spark)
    print(f"{wrong} differences")
    return min(wrong, 1)


if __name__ == "__main__":
    raise SystemExit(main())
