"""Distinct counts that can be merged: exact bitmaps of numbered keys.

Every key gets a number once and for all, in a dictionary that only grows. The keys for which a metric
holds are then a bitmap: rows of (metric, bucket, bits), 32,768 numbers to a bucket. Bitmaps of several
days are merged by ``or``, so distinct counts over a week need the bitmaps of its days and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.operators.aggregates import marks_by_key
from rosterlane.operators.columns import quoted
from rosterlane.operators.skew import not_null

NUMBER = "number"


def number_keys(df: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """(key, number) of the non-null keys of ``df`` that ``known`` does not have yet.

    Numbers go on from the highest known one, or start at 1. Keys are numbered where they are, with the
    counts of the partitions before added, so no task sees all of them. The partitions are written to
    ``spark.checkpoint.dir`` first, as a number must not change when a task is repeated.
    """
    keys = df.where(not_null([key])).select(F.col(quoted(key)).alias("key")).distinct()
    start = 0
    if known is not None:
        named = known.select(F.col(quoted(key)).alias("key"), F.col(NUMBER))
        start = named.agg(F.max(NUMBER)).first()[0] or 0
        keys = keys.join(named.select("key"), "key", "anti")
    placed = keys.withColumn("part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per partition, however many keys there are.
    offsets = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    numbered = placed.withColumn("within", within).join(offsets, "part")
    return numbered.select(F.col("key").alias(key), (F.lit(start) + F.col("offset") + F.col("within")).alias(NUMBER))


def metric_bitmaps(
    df: DataFrame, key: str, numbers: DataFrame, metrics: Mapping[str, Column | str | None]
) -> DataFrame:
    """(metric, bucket, bits): per metric the numbers of the keys with a row for which it holds.

    Rows are reduced to a mark per key and metric first; a metric of None holds for every key. Every key
    has to be in ``numbers``.
    """
    marks = marks_by_key(df, key, {n: "true" if p is None else p for n, p in metrics.items()})
    named = numbers.select(F.col(quoted(key)).alias("numbered key"), NUMBER)
    met = marks.join(named, F.col(quoted(key)) == F.col("numbered key"))
    held = F.array(*(F.when(F.col(quoted(n)), F.lit(n)) for n in metrics))
    each = met.select(NUMBER, F.explode(F.array_compact(held)).alias("metric"))
    return each.groupBy("metric", F.bitmap_bucket_number(NUMBER).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(NUMBER))).alias("bits")
    )


def bitmap_counts(bitmaps: DataFrame, metrics: Mapping[str, Column | str | None]) -> DataFrame:
    """One row: per metric the distinct keys in any of the bitmaps, which may be of several days."""
    merged = bitmaps.groupBy("metric", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy("metric").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    sums = (F.sum(F.when(F.col("metric") == n, F.col("n"))) for n in metrics)
    return counted.agg(*(F.coalesce(s, F.lit(0)).cast("long").alias(n) for n, s in zip(metrics, sums)))
