"""Compare registered queries with their checking SQL on one test-data folder.

Usage: python -m verification.compare FOLDER [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from linespan.session import build_session, table_path
from verification.queries import checking_sql, spark_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{table_path(folder, table)}')"
        )
    return connection


def _normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    return str(value)


def compare(spark: SparkSession, connection, folder: str, name: str, run, sql: str | None):
    """Return (matches, note). Rows are compared as multisets."""
    rows = run(spark, folder)
    columns = sorted(rows.columns)
    got = [tuple(_normal(v) for v in row) for row in rows.select(*columns).collect()]
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    started = time.time()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return False, f"columns differ: {sorted(set(names) ^ set(columns))}"
    order = [names.index(c) for c in columns]
    want = [tuple(_normal(row[i]) for i in order) for row in result.fetchall()]
    if Counter(got) == Counter(want):
        return True, f"{len(got)} rows (checking SQL {time.time() - started:.1f}s)"
    extra = list((Counter(got) - Counter(want)).elements())
    missing = list((Counter(want) - Counter(got)).elements())
    detail = ""
    if extra and missing:
        a, b = min(extra, key=str), min(missing, key=str)
        detail = "; ".join(
            f"{c}: {x} vs {y}" for c, x, y in zip(columns, a, b, strict=True) if x != y
        )
    return False, f"{len(got)} vs {len(want)} rows, {len(extra)} extra: {detail[:600]}"


def main(arguments: list[str]) -> int:
    folder, *names = arguments
    spark = build_session(
        master="local[8]", shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g",
               "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(folder)
    runs, checks = spark_queries(), checking_sql()
    failed = []
    for name in names or runs:
        started = time.time()
        try:
            ok, note = compare(spark, connection, folder, name, runs[name], checks.get(name))
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
