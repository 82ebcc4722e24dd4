"""Operators that depend on row order. The order is always given by columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.operators.columns import quoted
from rosterlane.operators.skew import HOT_ROWS, HotKeys, equal, hot_parts

FORWARD = "ffill_bfill"
BACKWARD = "bfill_ffill"

# Bits of ``monotonically_increasing_id`` that number the rows of a partition.
PLACE_BITS = 33


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key; null keys count as equal.

    Ties of ``order`` are broken by the remaining columns, so the pick is always the same. Each
    task keeps one row per key before the shuffle (window group limit), so a hot key is no burden.
    """
    ties = [
        f.name
        for f in df.schema
        if f.name not in {*keys, *order} and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    place = f"row_number() over (partition by {_list(keys)} order by {_list([*order, *ties])})"
    return df.withColumn("row place", F.expr(place)).where("`row place` = 1").drop("row place")


def ranked_first(
    df: DataFrame, key: str, rank: Column, order: Sequence[str] = ()
) -> DataFrame:
    """The row of lowest rank per key; equal ranks by ``order``, then by the remaining columns."""
    ranked = df.withColumn("row rank", rank)
    return first_per_key(ranked, [key], ["row rank", *order]).drop("row rank")


def fill_within_group(
    df: DataFrame,
    group: str | Sequence[str],
    columns: Mapping[str, str],
    order: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill nulls from the rows of the same group.

    ``columns`` maps column to mode. FORWARD takes the nearest earlier value and, before the first
    value of the group, that first value; BACKWARD takes the nearest later value and, after the last
    value, that last value. Rows without a group (null) get null. ``order`` is unique in a group.

    Groups of ``hot_rows`` rows and more (found when the fill is made, by one pass over the group
    columns) are cut along the order into runs of about half as many rows. Each run is filled on its
    own, and what crosses the edge of a run comes from a small table with the first and the last value
    of every run. So no task sees a whole hot group. The runs are pieces of a range partitioning of the
    hot groups' rows, which are written once, to the folder ``spark.checkpoint.dir`` names.
    """
    keys = [group] if isinstance(group, str) else list(group)
    hot = hot_parts(df, keys, hot_rows)
    # Rows without a group need no neighbours; where they are many, they are spread over all tasks.
    loose = " or ".join(f"{quoted(k)} is null" for k in keys)
    alone = f"if({loose}, xxhash64({_list(order)}), 0L) as `fill run`"
    if not hot:
        # Partitioned by the group alone, which what follows per group can use without a shuffle.
        return _filled(df, keys, columns, order, run=())
    if hot.parts is None:
        return _filled(df.selectExpr("*", alone), keys, columns, order).select(*map(quoted, df.columns))
    cut = _cut_into_runs(df, keys, order, hot_rows, hot)
    names = [f"hot {k}" for k in keys]
    cold = df.join(F.broadcast(hot.parts.toDF(*names, "parts")), equal(keys, names), "anti")
    seeds = _seeds(cut, keys, columns, order)
    both = [
        _filled(cold.selectExpr("*", alone), keys, columns, order),
        _filled(cut, keys, columns, order, seeds),
    ]
    return both[0].select(*map(quoted, df.columns)).unionAll(both[1].select(*map(quoted, df.columns)))


def _filled(
    runs: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, str],
    order: Sequence[str],
    seeds: DataFrame | None = None,
    run: Sequence[str] = ("fill run",),
) -> DataFrame:
    """Fill every run on its own and, where it has none, from its seed; without ``run``, every group."""
    values = []
    for column, mode in columns.items():
        span = f"partition by {_list([*keys, *run])} order by {_sorted(order, mode)} rows"
        start = "between unbounded preceding and"
        near = f"last({quoted(column)}, true) over ({span} {start} current row)"
        far = f"first({quoted(column)}, true) over ({span} {start} unbounded following)"
        values += [f"{near} as `near {column}`", f"{far} as `far {column}`"]
    filled = runs.selectExpr("*", *values)
    if seeds is not None:
        same = [f"{quoted(k)} = `seed key {i}`" for i, k in enumerate(keys)]
        filled = filled.join(seeds, F.expr(" and ".join([*same, "`fill run` = `seed run`"])), "left")
    known = " and ".join(f"{quoted(k)} is not null" for k in keys)

    def result(name: str) -> str:
        if name not in columns:
            return quoted(name)
        beyond = f"`seed {name}`" if seeds is not None else f"`far {name}`"
        return f"if({known}, coalesce(`near {name}`, {beyond}), null) as {quoted(name)}"

    return filled.selectExpr(*map(result, runs.columns))


def _list(columns: Sequence[str]) -> str:
    return ", ".join(map(quoted, columns))


def _sorted(columns: Sequence[str], mode: str) -> str:
    # Nulls last when descending: the exact reverse of ascending.
    way = "asc nulls first" if mode == FORWARD else "desc nulls last"
    return ", ".join(f"{quoted(c)} {way}" for c in columns)


def _cut_into_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int, hot: HotKeys | None = None
) -> DataFrame:
    """The rows of the hot groups with their run, which never decreases along the order of a group.

    The rows go through a range partitioning, whose bounds come from a sample of them, and each range is
    sorted and cut after every so many rows: so runs are even in rows, whatever values the order has:
    numbers far apart, fractions, ties of the leading column, nulls. There are no more ranges than
    shuffle partitions, so neither tasks nor the sample grow with the rows; a range is only sorted and
    streamed. The runs are written, as everything else refers to them.
    """
    hot = hot or hot_parts(df, keys, hot_rows)
    names = [f"hot {k}" for k in keys]
    of_hot = df.join(F.broadcast(hot.parts.toDF(*names, "parts")), equal(keys, names), "semi")
    each = max(1, hot_rows // 2)
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(quoted(c)) for c in (*keys, *order)]
    ranged = of_hot.repartitionByRange(min(most, -(-hot.rows // each)), *by).sortWithinPartitions(*by)
    # The upper bits of such a number are the partition's, the lower ones the row's place in it.
    placed = ranged.withColumn("fill run", F.monotonically_increasing_id())
    start = f"`fill run` - `fill run` % {1 << PLACE_BITS}L % {each}L"
    return placed.withColumn("fill run", F.expr(start)).checkpoint()


def _seeds(
    cut: DataFrame, keys: Sequence[str], columns: Mapping[str, str], order: Sequence[str]
) -> DataFrame:
    """Per run of a hot group: the value that reaches into it from the other runs."""
    at = f"struct({_list(order)})"
    ends, seeds = [], []
    for column, mode in columns.items():
        first, last = ("min_by", "max_by") if mode == FORWARD else ("max_by", "min_by")
        known = f"{quoted(column)}, if({quoted(column)} is not null, {at}, null)"
        ends += [
            F.expr(f"{first}({known})").alias(f"first {column}"),
            F.expr(f"{last}({known})").alias(f"last {column}"),
        ]
        span = f"partition by {_list(keys)} order by {_sorted(['fill run'], mode)} rows"
        start = "between unbounded preceding and"
        before = f"last(`last {column}`, true) over ({span} {start} 1 preceding)"
        nearest = f"first(`first {column}`, true) over ({span} {start} unbounded following)"
        seeds.append(f"coalesce({before}, {nearest})")
    runs = cut.groupBy(*map(quoted, keys), "fill run").agg(*ends)
    names = [f"seed key {i}" for i in range(len(keys))]
    return runs.selectExpr(*map(quoted, keys), "`fill run`", *seeds).toDF(
        *names, "seed run", *(f"seed {c}" for c in columns)
    )
