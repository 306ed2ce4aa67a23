"""Run registered queries and their DuckDB twins side by side.

    python -m verification.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from verification import oracle, registry

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    return f"{value:f}" if isinstance(value, Decimal) else value


def difference(
    spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str
) -> tuple[str | None, int]:
    """What differs, if anything, and the number of rows."""
    df = registry.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    ours = Counter(
        tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()
    )
    cursor = connection.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != names:
        return f"columns {names} and {sorted(columns)}", sum(ours.values())
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[k]) for k in order) for row in cursor.fetchall())
    if ours == theirs:
        return None, sum(ours.values())
    only_ours, only_theirs = ours - theirs, theirs - ours
    return (
        f"{sum(only_ours.values())} rows only in Spark, e.g. {list(only_ours)[:2]}; "
        f"{sum(only_theirs.values())} only in DuckDB, e.g. {list(only_theirs)[:2]}",
        sum(ours.values()),
    )


def main(sf_dir: str, chosen: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    assert set(registry.QUERIES) == set(oracle.QUERIES), set(registry.QUERIES) ^ set(oracle.QUERIES)
    for name in chosen or registry.QUERIES:
        start = time.time()
        try:
            problem, rows = difference(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} rows={rows} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(bool(main(args[0] if args else "/root/testdata/sf0.01", args[1:])))
