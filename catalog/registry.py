"""Registration of queries and access to the tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def with_shared_folder(spark: SparkSession) -> None:
    """Queries that write need a folder that all executors see. A session on one machine that names
    none gets one here; the library itself only takes what the session names."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterlane-"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` (under its name, if none is given) and the SQL of the
    same result."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            with_shared_folder(spark)
            return build(Tables(spark, folder))

        QUERIES[name or build.__name__] = run
        if sql is not None:
            ORACLE[name or build.__name__] = sql
        return build

    return register
