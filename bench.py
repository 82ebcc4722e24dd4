"""Time all queries on the campaign's operators and print one JSON line.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local threads. Every query is
run twice to its last row, which goes to the ``noop`` sink. ``first`` has the times of the first run,
in a session that has run the queries before it; ``queries`` and ``value`` the better of both.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from catalog import QUERIES

def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    first, best = {}, {}
    for name in names:
        first[name] = round(run(spark, name, folder), 3)
        best[name] = min(first[name], round(run(spark, name, folder), 3))
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first": first,
        "first_value": round(sum(first.values()), 3),
        "sf": float(folder.rstrip("/").rsplit("sf", 1)[-1]) if "sf" in folder else folder,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
