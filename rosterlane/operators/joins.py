"""Equi-joins that stand a key (or null) with a great share of the rows.

Adaptive execution can split a hot partition of a join only when both sides come straight from a
shuffle, which an aggregated side does not, and never on the right of a left join. So rows of a hot
key are salted: dealt over as many parts as the key needs, with the matching rows of the other side
repeated for each part; a key that is hot on both sides makes a grid of parts with no more cells than
there are shuffle partitions, whose rows meet in blocks (see ``_join_blocks``). Which keys are hot is
looked up when the join is made (see ``skew``), by one pass over the key columns; without any, the join
is a plain one. Sides with few rows per key need no look: ``even`` says so of the left side, ``unique``
of the right one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane.functions.text import is_blank
from rosterlane.operators.columns import fold, quoted
from rosterlane.operators.skew import (
    HOT_ROWS,
    HotKeys,
    equal,
    gridded,
    hot_parts,
    not_null,
    row_hash,
    spread,
)

Keys = str | Sequence[str]
# Rows of a block, where a key is hot on both sides.
BLOCK_ROWS = 128
SALTS = ["left salt", "right salt"]
RIGHT_SALTS = ["left salt of right", "right salt of right"]


def _names(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_on: Keys,
    right_on: Keys | None = None,
    unique: bool = False,
    even: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join that keeps every match; null keys match nothing.

    Column names of the sides must differ, but for key columns of the same name, which are kept
    once. ``unique``: ``right`` has at most one row per key. ``even``: ``left`` has few rows per key
    and few without one.
    """
    lefts, rights = _names(left_on), _names(right_on or left_on)
    shared = {r: f"right {r}" for l, r in zip(lefts, rights) if l == r}
    right, rights = right.withColumnsRenamed(shared), [shared.get(r, r) for r in rights]
    hot_left = HotKeys() if even else hot_parts(left, lefts, hot_rows)
    # Rows without a key on the right match nothing and are left out.
    hot_right = HotKeys() if unique else hot_parts(right.where(not_null(rights)), rights, hot_rows)
    if not hot_left and not hot_right:
        return left.join(right, equal(lefts, rights), "left").drop(*shared.values())
    hot_left, hot_right = gridded(hot_left, hot_right, lefts, rights)

    one = spread(left, lefts, hot_left, hot_right, *SALTS)
    # A hot key is present on the right: what a copy of a left row does not meet, another one does.
    copies = "repeated"
    if hot_right.parts is not None:
        names = [f"hot {k}" for k in lefts]
        hot = F.broadcast(hot_right.parts.toDF(*names, copies))
        one = one.join(hot, equal(lefts, names), "left").drop(*names)
    other = spread(
        right.where(not_null(rights)), rights, hot_right, hot_left, *reversed(RIGHT_SALTS)
    ).withColumn("right row", F.lit(True))
    on = [*lefts, *SALTS], [*rights, *RIGHT_SALTS]
    if hot_left.met:
        return _join_blocks(one, other, *on, copies).drop(copies, *shared.values())
    joined = one.join(other, equal(*on), "left")
    if hot_right.parts is not None:
        joined = joined.where(f"`right row` or coalesce(`{copies}`, 1) = 1").drop(copies)
    return joined.drop(*SALTS, *RIGHT_SALTS, "right row", *shared.values())


def _join_blocks(
    one: DataFrame, other: DataFrame, lefts: Sequence[str], rights: Sequence[str], copies: str
) -> DataFrame:
    """The join of sides that were spread, where a key is hot on both, so that its rows come out as a product.

    Blocks of rows are joined, and every pair of blocks is expanded. So a few values recur at short
    distance in what is written, which encodes to a fraction of the bytes that rows of one side take,
    each followed by all of the other. Tasks are as many as shuffle partitions, however small the sides
    are, as it is the product that takes the time.
    """
    places = _places(one)
    names = ["left block", "right block"]
    pairs = _blocks(one, lefts, names[0]).join(_blocks(other, rights, names[1]), equal(lefts, rights), "left")
    # A hot key is present on the right: what a copy of a left row does not meet, another one does.
    met = pairs.where(f"`right block` is not null or coalesce(`left block`[0].{quoted(copies)}, 1) = 1")
    # The coalesce joins no partitions. It keeps the expansion out of the code generated for the join, which
    # holds all that comes of a row of the left side in memory: now the pairs of a block, not their rows.
    rows = met.coalesce(places).selectExpr("inline(`left block`)", "`right block`")
    return rows.selectExpr("*", "inline_outer(`right block`)").drop(names[1])


def _blocks(df: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Blocks of at most ``BLOCK_ROWS`` rows that agree in ``on``. All columns but salts are in the
    block, keys too, as grouping may change how a number is written (-0.0)."""
    keys = [quoted(c) for c in on]
    # Rows are in the order of a hash, so that the blocks are the same on every attempt.
    sorted_rows = df.repartition(_places(df), *keys).sortWithinPartitions(*keys, row_hash(df))
    numbered = sorted_rows.withColumn("block", F.expr(f"monotonically_increasing_id() div {BLOCK_ROWS}"))
    salts = {*SALTS, *RIGHT_SALTS, "right row"}
    row = F.struct(*(quoted(c) for c in df.columns if c not in salts))
    return numbered.groupBy(*keys, "block").agg(F.collect_list(row).alias(name)).drop("block")


def _places(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def merge_suffixed(
    left: DataFrame,
    right: DataFrame,
    left_on: Keys,
    right_on: Keys | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    **options,
) -> DataFrame:
    """``left_join`` of sides whose column names clash; both get a suffix, which may be empty."""
    lefts, rights = _names(left_on), _names(right_on or left_on)
    shared = {r for l, r in zip(lefts, rights) if l == r}
    same = fold(left.sparkSession)
    clash = {same(c) for c in left.columns} & {same(c) for c in right.columns}
    clash -= {same(c) for c in shared}

    def suffixed(df: DataFrame, keys: list[str], suffix: str) -> tuple[DataFrame, list[str]]:
        names = {c: c + suffix for c in df.columns if same(c) in clash}
        return df.withColumnsRenamed(names), [names.get(k, k) for k in keys]

    one, one_on = suffixed(left, lefts, suffixes[0])
    other, other_on = suffixed(right, rights, suffixes[1])
    return left_join(one, other, one_on, other_on, **options)


def exists_flag(
    df: DataFrame,
    ref: DataFrame,
    on: str,
    ref_on: str | None = None,
    flag: str = "exists",
    **options,
) -> DataFrame:
    """All rows of ``df`` with a boolean column: does the key occur in ``ref``?

    Null never occurs; rows of ``df`` are never multiplied.
    """
    marks = _distinct_keys(ref, _names(ref_on or on)).withColumn(flag, F.lit(True))
    kept = df.select(*(quoted(c) for c in df.columns if c != flag))
    joined = left_join(kept, marks, on, "match 0", unique=True, **options)
    return joined.drop("match 0").fillna(False, subset=[flag])


def keep_matching(
    df: DataFrame,
    ref: DataFrame,
    on: Keys,
    ref_on: Keys | None = None,
    even: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rows whose key occurs in ``ref`` (semi-join). ``even``: ``df`` has few rows per key."""
    lefts, marks = _names(on), _distinct_keys(ref, _names(ref_on or on))
    known = df.where(not_null(lefts))
    # Rows without a key are left out, so only keys can be hot.
    hot = HotKeys() if even else hot_parts(known, lefts, hot_rows)
    if not hot:
        return known.join(marks, equal(lefts, marks.columns), "semi")
    one = spread(known, lefts, hot, None, *SALTS).drop(SALTS[1])
    other = spread(marks, marks.columns, None, hot, *reversed(RIGHT_SALTS)).drop(RIGHT_SALTS[1])
    on_salted = equal([*lefts, SALTS[0]], [*marks.columns, RIGHT_SALTS[0]])
    return one.join(other, on_salted, "semi").drop(SALTS[0])


def lookup_override(
    df: DataFrame,
    mapping: DataFrame,
    on: str,
    column: str,
    value: str,
    mapping_on: str | None = None,
    only_blank: bool = False,
    **options,
) -> DataFrame:
    """Replace ``column`` by the mapped value where the key is mapped, else keep it.

    Of a key that is mapped more than once, the smallest value counts; rows are never multiplied. A
    key mapped to null counts as not mapped. With ``only_blank`` present values are kept.
    """
    names = ["lookup key", "lookup value"]
    named = mapping.select(quoted(mapping_on or on), quoted(value)).toDF(*names)
    side = named.where(not_null(names)).groupBy(quoted(names[0])).agg(
        F.min(quoted(names[1])).alias(names[1])
    )
    old = F.col(quoted(column))
    new = F.coalesce(F.col(quoted(names[1])), old)
    if only_blank:
        new = F.when(is_blank(old), new).otherwise(old)
    joined = left_join(df, side, on, names[0], unique=True, **options)
    return joined.withColumn(column, new).drop(*names)


def _distinct_keys(ref: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur, made unique before (and after) they are shuffled."""
    names = [f"match {i}" for i in range(len(keys))]
    return ref.where(not_null(keys)).select(*map(quoted, keys)).toDF(*names).distinct()
