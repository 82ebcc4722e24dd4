"""Helpers of several operators: words, shared folders, keys that hold many rows."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words are maximal runs of other characters than these six.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# A key with over 1/HEAVY of all rows is heavy; so there are fewer than HEAVY such keys.
HEAVY = 1000


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        return name

    return [free(name) for name in names]


def words_of(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN, -1)
    )


def with_shared_folder(spark: SparkSession) -> None:
    """Name a folder where the session names none. Only a session on one machine gets one."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rosterlane-"))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share (``spark.checkpoint.dir``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, as with checkpoint()."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(name: str, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task; the package itself travels with each of them."""
    kept = sys.__dict__.setdefault("_rosterlane_kept", {})
    if name not in kept:
        kept[name] = build()
    return kept[name]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_unique(
    left: DataFrame, right: DataFrame, key: str, rows: int, heavy_count: str = "key_rows"
) -> DataFrame:
    """Left join with a side that has one row per key and, in ``heavy_count``, how many left rows
    hold the key.

    Keys with more than ``rows`` / HEAVY rows are fewer than HEAVY, whatever the data; these few rows
    of the right side are broadcast, and their left rows are not shuffled. All other keys are joined
    by a shuffle, where none holds more than 1/HEAVY of the rows.
    """
    heavy = F.col(heavy_count) > rows / HEAVY
    marks = F.broadcast(right.where(heavy).select(F.col(key).alias("heavy key")))
    hot = F.broadcast(right.where(heavy))
    one = left.join(hot, key)
    rest = left.join(marks, F.col(key) == F.col("heavy key"), "anti")
    return one.unionByName(rest.join(right.where(~heavy), key, "left"))


def sum_before(
    df: DataFrame, keys: list[str], run: str, order: list[Column], value: str, name: str
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same keys that come earlier.

    ``run`` is a number that never falls along the order. Sums are taken within the runs and over the
    runs, so that no window holds all rows of a key.
    """
    totals = df.groupBy(*keys, run).agg(F.sum(value).alias("of run"))
    before = (Window.unboundedPreceding, -1)
    over_runs = Window.partitionBy(*keys).orderBy(run).rowsBetween(*before)
    totals = totals.withColumn("of runs", F.sum("of run").over(over_runs)).drop("of run")
    inside = Window.partitionBy(*keys, run).orderBy(*order).rowsBetween(*before)
    near = df.withColumn("of rows", F.sum(value).over(inside)).join(totals.hint("merge"), [*keys, run])
    zero = F.lit(0).cast("long")
    both = F.coalesce("of rows", zero) + F.coalesce("of runs", zero)
    return near.withColumn(name, both).drop("of rows", "of runs")
