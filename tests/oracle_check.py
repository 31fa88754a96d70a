"""Compare registered queries with their DuckDB counterparts.

Usage: python tests/oracle_check.py [scale, default sf0.001] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("customer", "nation", "orders", "lineitem", "supplier", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


spark_seconds = 0.0


def plain(value):
    """A value in a form both engines agree on."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    lines = [tuple(plain(row[i]) for i in order) for row in rows]
    return named, sorted(lines, key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def difference(connection, df, sql: str) -> str | None:
    """None if both sides agree, else the first few differing rows."""
    started = time.time()
    got_columns, got = table(df.columns, df.collect())
    global spark_seconds
    spark_seconds = time.time() - started
    relation = connection.execute(sql)
    want_columns, want = table([c[0] for c in relation.description], relation.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got == want:
        return None
    extra = [r for r in got if r not in set(want)][:3]
    lacking = [r for r in want if r not in set(got)][:3]
    return f"{len(got)} rows, expected {len(want)}; columns {got_columns}; extra {extra}; lacking {lacking}"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    scale = sys.argv[1] if len(sys.argv) > 1 else "sf0.001"
    sf_dir = f"/root/testdata/{scale}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        start, built = time.time(), 0.0
        try:
            df = queries[name](spark, sf_dir)
            built = time.time() - start
            found = difference(connection, df, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:600]}"
        ok = found is None or found.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s (built {built:.1f}s, run {spark_seconds:.1f}s) {found or ''}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
