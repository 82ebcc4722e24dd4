"""Run queries on Spark and their SQL on DuckDB over the same tables and compare all rows.

    python tools/compare.py FOLDER [QUERY ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalog import ORACLE, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(canonical(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, connection, name: str, folder: str) -> str:
    """Empty when both give the same columns and rows, else what differs."""
    df = QUERIES[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    cursor = connection.execute(ORACLE[name])
    names = [column[0] for column in cursor.description]
    wanted = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows / {len(wanted)}"
    for one, other in zip(got, wanted):
        if one != other:
            return f"{one} / {other}"
    return "" if got else "no rows"


def main() -> int:
    folder, *wanted = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in wanted or QUERIES:
        start = time.time()
        try:
            difference = compare(spark, connection, name, folder)
        except Exception as error:  # report and go on with the next query
            difference = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(difference)
        print(f"{name:28} {time.time() - start:6.2f}s {difference or 'same'}", flush=True)
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
