"""Run the registered queries against their SQL in DuckDB, locally."""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import SparkSession

from tarmac.checks.oracle import ORACLE
from tarmac.checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return db


def _sorted_rows(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(spark: SparkSession, sf: str, name: str, db: duckdb.DuckDBPyConnection | None = None) -> str | None:
    """None if query and SQL agree in columns and rows, else what differs."""
    df = QUERIES[name](spark, sf)
    found = _sorted_rows(df.columns, df.collect())
    if name not in ORACLE:
        return None if found else "no rows"
    result = (db or connect(sf)).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = _sorted_rows(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if found != expected:
        extra, absent = set(found) - set(expected), set(expected) - set(found)
        return f"{len(found)} rows, expected {len(expected)}; extra {list(extra)[:2]}, absent {list(absent)[:2]}"
    return None


def main() -> int:
    from tarmac.session import build_session

    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, sf, name)
        except Exception as e:  # report every query, then fail
            problem = f"{type(e).__name__}: {e}"[:1500]
        failed += problem is not None
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name:24s} {kind:4s} {time.time() - start:6.2f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
