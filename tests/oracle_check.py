"""Compare registered queries with their SQL at one scale, values and types.

``python tests/oracle_check.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def mismatch(frame, connection, sql: str) -> str | None:
    """What differs between a DataFrame and the SQL, or None."""
    found = connection.execute(sql)
    columns = [d[0] for d in found.description]
    expected = found.fetchall()
    actual = frame.collect()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    ours, theirs = _rows(frame.columns, actual), _rows(columns, expected)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
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
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            if name in oracles:
                problem = mismatch(frame, connection, oracles[name])
            else:
                problem = f"no SQL, {frame.count()} rows"
        except Exception as error:  # report every query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem) and name in oracles
        print(f"{'ok  ' if not problem else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
