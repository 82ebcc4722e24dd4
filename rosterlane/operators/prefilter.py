"""Leaving out rows of a large side before they are shuffled, by a Bloom filter of the wanted keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.operators.columns import quoted
from rosterlane.operators.skew import not_null

# Bits of a filter per wanted key, hashes per key, and the most words of 64 bits: 8 MB. With 16 bits and
# 4 hashes a quarter of a percent of the other keys pass.
BITS_PER_KEY = 16
HASHES = 4
MOST_WORDS = 1 << 20


def _words_of(count: int) -> int:
    return max(1, -(-count * BITS_PER_KEY // 64))


def _bit(keys: Sequence[Column], lane: int, words: int) -> Column:
    """The place of a key's bit: a hash of the key, the same whatever column it stands in."""
    return F.pmod(F.xxhash64(F.lit(lane), *keys), F.lit(64 * words))


def _as_text(columns: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)).cast("string") for c in columns]


def prefiltered(
    df: DataFrame, wanted: DataFrame, on: Sequence[str], wanted_on: Sequence[str] | None = None
) -> DataFrame:
    """The rows of ``df`` whose key may occur in ``wanted``: all that do, and few others.

    For use before a join that needs the keys anyway. The filter has BITS_PER_KEY bits for every
    different wanted key; where it would be larger than MOST_WORDS the rows are left as they are, but
    for those without a key. It is one row, of at most 8 MB, which every task gets; rows are tested by
    the task that reads them, ahead of any shuffle. Key columns have the same types on both sides.
    """
    theirs = list(wanted_on or on)
    known = df.where(not_null(on))
    keys = wanted.where(not_null(theirs)).select(*(c.alias(f"k{i}") for i, c in enumerate(_as_text(theirs)))).distinct()
    words = _words_of(keys.count())
    if words > MOST_WORDS:
        return known
    names = [F.col(f"k{i}") for i in range(len(theirs))]
    places = F.explode(F.array(*(_bit(names, lane, words) for lane in range(HASHES))))
    bits = keys.select(places.alias("place")).groupBy((F.col("place") / 64).cast("int").alias("word"))
    ored = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
    # All words in their order: one row, whose length is known before.
    every = df.sparkSession.range(words).withColumnRenamed("id", "at")
    listed = every.join(ored, F.col("at") == F.col("word"), "left").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("pairs")
    )
    row = listed.select(F.transform("pairs", lambda p: p["bits"]).alias("filter words"))
    place = [_bit(_as_text(on), lane, words) for lane in range(HASHES)]
    tests = F.lit(True)
    for p in place:
        tests &= F.bit_get(F.get("filter words", (p / 64).cast("int")), (p % 64).cast("int")) == 1
    # One row on the other side: this multiplies nothing.
    return known.crossJoin(F.broadcast(row)).where(tests).drop("filter words")
