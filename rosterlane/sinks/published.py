"""Products of one day, published together.

Every run writes its products to folders of its own, checks them, and then names itself as the day's
run by creating one empty file, the pointer; readers follow the pointers. So a run that dies before, at
whatever place, changes nothing that is read: the day keeps the products of the run before, all of them.

    <store>/<product>/<day>/<run>/part files
    <store>/published/<day>/<number>-<run>
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rosterlane.sinks.files import children, quote, remove

POINTERS = "published"


def publish_day(
    spark: SparkSession,
    store: str,
    day: str,
    products: Mapping[str, DataFrame],
    check: Callable[[Mapping[str, DataFrame]], None] | None = None,
) -> dict[str, DataFrame]:
    """Write the day's products and publish them at once; returns them as they were written.

    ``check`` sees the written products before they are published, and raises if they are not to be.
    What earlier runs of the day have left and nobody reads is removed first; the run that is replaced
    stays until the next one, for those who are reading it.
    """
    store = store.rstrip("/")
    pointers = _pointers(spark, store, day)
    current = pointers[-1].partition("-")[2] if pointers else None
    for name in products:
        for run in children(spark, f"{store}/{name}/{quote(day)}"):
            if run != current:
                remove(spark, f"{store}/{name}/{quote(day)}/{run}")

    run = uuid.uuid4().hex
    written = {}
    for name, df in products.items():
        path = f"{store}/{name}/{quote(day)}/{run}"
        df.hint("rebalance").write.parquet(path)
        written[name] = spark.read.schema(df.schema).parquet(path)
    if check is not None:
        check(written)
    number = int(pointers[-1].partition("-")[0]) + 1 if pointers else 0
    folder = f"{store}/{POINTERS}/{quote(day)}"
    _create(spark, f"{folder}/{number:012d}-{run}")
    for old in pointers:
        remove(spark, f"{folder}/{old}")
    return written


def published_runs(spark: SparkSession, store: str, name: str) -> dict[str, str]:
    """Day to folder of a product, of all published days; one small listing per day."""
    store = store.rstrip("/")
    found = {}
    for day in children(spark, f"{store}/{POINTERS}"):
        pointers = children(spark, f"{store}/{POINTERS}/{day}")
        if pointers:
            found[day] = f"{store}/{name}/{day}/{pointers[-1].partition('-')[2]}"
    return found


def read_published(
    spark: SparkSession,
    store: str,
    name: str,
    days: Iterable[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """The rows of a product, of all published days or of the ``days`` asked for.

    A day that is asked for and not published raises, and so does a store without any day, unless the
    ``schema`` says what an empty product looks like.
    """
    runs = published_runs(spark, store, name)
    wanted = list(runs) if days is None else [quote(day) for day in days]
    absent = [day for day in wanted if day not in runs]
    if absent or not (wanted or schema):
        raise ValueError(f"{name}: not published: {', '.join(absent) or 'any day'}")
    if not wanted:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*(runs[day] for day in wanted))


def _pointers(spark: SparkSession, store: str, day: str) -> list[str]:
    return children(spark, f"{store}/{POINTERS}/{quote(day)}")


def _create(spark: SparkSession, path: str) -> None:
    """An empty file; one that is there already raises."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.create(target, False).close()
