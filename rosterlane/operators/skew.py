"""Finding the keys that hold too many rows for one task, and spreading them over several.

One pass over a side makes a summary of its keys: each task keeps a sketch of bounded size of the most
frequent ones, and the sketches are merged. Only the few candidates that come out, at most ``MOST``,
are then counted exactly, and only if there are any. So no side is grouped by key to find its hot ones,
what is sent about is a sketch per task, and what is broadcast is a list of at most ``MOST`` keys. A
side without hot keys is joined as it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.operators.columns import quoted

# A key with this many rows is treated apart: its rows are never put into a single task.
HOT_ROWS = 1_000_000

# Keys that a sketch keeps track of, and the most that come out. A key with more than a 2000th of all
# rows is certainly found; one with fewer is no more than a task's fair share of so large a table.
TRACKED = 8192
MOST = 2000

# Rows without a key match nothing; where they are many, they are spread over this many places.
LOOSE_PLACES = 1 << 20


def not_null(names: Sequence[str]) -> Column:
    """None of the columns is null; the scan can evaluate it."""
    return F.expr(" and ".join(f"{quoted(name)} is not null" for name in names))


def equal(lefts: Sequence[str], rights: Sequence[str]) -> Column:
    return F.expr(" and ".join(f"{quoted(l)} = {quoted(r)}" for l, r in zip(lefts, rights)))


@dataclass(frozen=True)
class HotKeys:
    """``parts``: the hot keys and the number of parts of each, a local table; None without any.
    ``rows``: how many rows they have together. ``loose``: rows without a key are as many as a hot key's.
    ``met``: some of them are hot on the other side as well."""

    parts: DataFrame | None = None
    rows: int = 0
    loose: bool = False
    met: bool = False

    def __bool__(self) -> bool:
        return self.parts is not None or self.loose


def hot_parts(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys:
    """The keys with at least ``hot_rows`` rows. This reads the key columns of ``df``."""
    names = ", ".join(map(quoted, keys))
    known = " and ".join(f"{quoted(k)} is not null" for k in keys)
    summary = df.selectExpr(
        f"approx_top_k(xxhash64({names}), {MOST}, {TRACKED}) filter (where {known}) as top",
        f"count_if(not ({known})) as loose",
    ).first()
    loose = summary["loose"] >= hot_rows
    hashes = [item["item"] for item in summary["top"] or [] if item["count"] >= hot_rows]
    if not hashes:
        return HotKeys(loose=loose)
    counted = (
        df.where(not_null(keys))
        .where(F.xxhash64(*map(quoted, keys)).isin(hashes))
        .groupBy(*map(quoted, keys))
        .agg(F.count("*").alias("hot count"))
        .where(F.col("hot count") >= hot_rows)
    )
    rows = counted.collect()
    if not rows:
        return HotKeys(loose=loose)
    schema = T.StructType([*counted.schema.fields[:-1], T.StructField("parts", T.IntegerType())])
    parts = [(*row[:-1], -(-row[-1] // hot_rows)) for row in rows]
    table = df.sparkSession.createDataFrame(parts, schema)
    return HotKeys(table, sum(row[-1] for row in rows), loose)


def gridded(
    left: HotKeys, right: HotKeys, lefts: Sequence[str], rights: Sequence[str]
) -> tuple[HotKeys, HotKeys]:
    """The sides' hot keys with fewer parts where a key is hot on both.

    Every part of one side meets every part of the other, so the rows of such a key are repeated as often
    as the other side has parts: the product of both sides. The parts are reduced in proportion until a
    key makes as many pairs of parts as there are shuffle partitions, as more would not spread it further.
    So what is repeated grows with the rows, not with their product.
    """
    if left.parts is None or right.parts is None:
        return left, right
    spark = left.parts.sparkSession
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ones, others = [f"hot {k}" for k in lefts], [f"other hot {k}" for k in rights]
    both = left.parts.toDF(*ones, "own parts").join(
        right.parts.toDF(*others, "other parts"), equal(ones, others)
    )
    if both.isEmpty():
        return left, right
    pairs = "cast(`own parts` as double) * `other parts`"

    def fewer(hot: HotKeys, keys: Sequence[str], names: Sequence[str], parts: str) -> HotKeys:
        share = f"round({quoted(parts)} * sqrt({most} / ({pairs})))"
        met = both.where(f"{pairs} > {most}").select(
            *map(quoted, names), F.expr(f"cast(least({most}, greatest(1, {share})) as int)").alias("fewer")
        )
        wanted = hot.parts.join(met, equal(keys, names), "left")
        rows = wanted.select(*map(quoted, keys), F.coalesce("fewer", "parts").alias("parts")).collect()
        return replace(hot, parts=spark.createDataFrame(rows, hot.parts.schema), met=True)

    return fewer(left, lefts, ones, "own parts"), fewer(right, rights, others, "other parts")


def spread(
    df: DataFrame,
    keys: Sequence[str],
    own: HotKeys | None,
    other: HotKeys | None,
    own_salt: str,
    other_salt: str,
) -> DataFrame:
    """Deal rows of the side's ``own`` hot keys over their parts, and repeat rows whose key is hot on
    the ``other`` side once for each of its parts. Other rows get the salt 0.

    Rows are dealt by the task that reads them and a hash of their plain columns: the same on every
    attempt, and even where hot rows are all alike. Columns of any other type are left alone.
    """
    names = [f"hot {k}" for k in keys]
    salted = df
    zero = F.lit(0)
    for hot, salt in ((own, own_salt), (other, other_salt)):
        if hot is None or (hot.parts is None and (salt == other_salt or not hot.loose)):
            salted = salted.withColumn(salt, zero)
            continue
        met = salted
        if hot.parts is not None:
            table = F.broadcast(hot.parts.toDF(*names, "hot parts"))
            met = salted.join(table, equal(keys, names), "left")
        else:
            met = salted.withColumn("hot parts", F.lit(None).cast("int"))
        if salt == own_salt:
            places = F.when(not_null(keys), F.coalesce("hot parts", F.lit(1))).otherwise(
                F.lit(LOOSE_PLACES)
            )
            value = F.pmod(row_hash(df) + F.spark_partition_id(), places).cast("int")
        else:
            value = F.explode(F.sequence(zero, F.coalesce("hot parts", F.lit(1)) - 1))
        salted = met.withColumn(salt, value).drop(*names, "hot parts")
    return salted


def row_hash(df: DataFrame) -> Column:
    plain = [
        f.name
        for f in df.schema
        if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
    ]
    return F.xxhash64(*(F.col(quoted(c)) for c in plain)) if plain else F.lit(0)
