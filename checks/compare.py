"""Side-by-side comparison of the registered queries with their SQL.

``python -m checks.compare [data folder] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from .catalog import REGISTRY
from .oracle import oracle_sql

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def difference(df, con, sql: str) -> str | int:
    """The number of rows when all columns and values agree, else what differs."""
    got_columns, got = df.columns, df.collect()
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(set(got_columns) ^ set(want_columns))}"
    got_rows, want_rows = _rows(got_columns, got), _rows(want_columns, want)
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} <> {len(want_rows)}"
    for a, b in zip(got_rows, want_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"values {a} <> {b}"
    return len(got_rows)


def main() -> int:
    from orderloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con, sql = local_session(), connect(sf_dir), oracle_sql()
    bad = 0
    for name in sys.argv[2:] or REGISTRY:
        start = time.time()
        try:
            found = difference(REGISTRY[name](spark, sf_dir), con, sql[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:300]}"
        bad += not isinstance(found, int)
        print(f"{name:32s} {time.time() - start:6.2f}s {found}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or REGISTRY)} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
