"""Compare the registered queries with their SQL on one folder of tables.

    python tests/compare.py [folder] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gustline")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def second_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _sorted(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(frame, connection, sql: str) -> list[str]:
    """Empty when both results have the same columns and the same rows."""
    ours = _sorted(frame.columns, frame.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = _sorted(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    if len(ours) != len(theirs):
        only = [r for r in set(ours) ^ set(theirs)][:4]
        return [f"rows {len(ours)} != {len(theirs)}", *map(str, only)]
    return [f"{a}\n    {b}" for a, b in zip(ours, theirs) if a != b][:3]


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(queries())
    spark, connection, failed = session(), second_engine(sf_dir), 0
    for name in chosen:
        started = time.time()
        try:
            found = differences(queries()[name](spark, sf_dir), connection, oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - started:.1f}s", flush=True)
        for line in found:
            print("   ", line)
    return failed


if __name__ == "__main__":
    sys.exit(main())
