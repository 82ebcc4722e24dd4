"""What has changed between two states of a table with a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.operators.columns import quoted

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def table_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ``change``, ``columns``): a row per key that was added, removed or changed, with the names
    of the columns that changed, in the order of ``after``.

    Keys are unique on either side; null is a key like others. Columns that only one side has count as
    null on the other. Rows are compared by two hashes of 64 bits, so that of unchanged rows nothing but
    the key and the hashes is shuffled; only of changed ones the columns are fetched.
    """
    names = [c for c in dict.fromkeys([*after.columns, *before.columns]) if c not in keys]
    ids = [f"key {i}" for i in range(len(keys))]

    def side(df: DataFrame, label: str) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        values = (_comparable(c, kinds[c]) if c in kinds else F.lit(None) for c in names)
        return df.select(
            *(F.col(quoted(k)).alias(f"{label} {i}") for k, i in zip(keys, ids)),
            *(v.alias(f"{label} column {n}") for n, v in enumerate(values)),
        )

    old, new = side(before, "old"), side(after, "new")

    def hashed(df: DataFrame, label: str) -> DataFrame:
        columns = [f"{label} column {n}" for n in range(len(names))]
        # Which columns are null is hashed too: hashes pass over nulls.
        marks = [F.col(quoted(c)).isNull() for c in columns]
        both = (F.xxhash64(F.lit(lane), *map(quoted, columns), *marks) for lane in (1, 2))
        return df.select(
            *(quoted(f"{label} {i}") for i in ids), *(h.alias(f"{label} hash {n}") for n, h in enumerate(both))
        )

    def same(one: str, other: str) -> Column:
        condition = F.lit(True)
        for i in ids:
            condition &= F.col(quoted(f"{one} {i}")).eqNullSafe(F.col(quoted(f"{other} {i}")))
        return condition

    met = hashed(old, "old").join(hashed(new, "new"), same("old", "new"), "full")
    gone, come = F.col("`new hash 0`").isNull(), F.col("`old hash 0`").isNull()
    equal = (F.col("`old hash 0`") == F.col("`new hash 0`")) & (F.col("`old hash 1`") == F.col("`new hash 1`"))
    change = F.when(come, ADDED).when(gone, REMOVED).when(~equal, CHANGED)
    differing = met.select(
        *(F.when(come, F.col(quoted(f"new {i}"))).otherwise(F.col(quoted(f"old {i}"))).alias(f"id {i}") for i in ids),
        change.alias("change"),
    ).where(F.col("change").isNotNull())
    wide = differing.join(old, same("id", "old") & (F.col("change") == CHANGED), "left")
    wide = wide.join(new, same("id", "new") & (F.col("change") == CHANGED), "left")
    changed = F.array(
        *(
            F.when(~F.col(quoted(f"old column {n}")).eqNullSafe(F.col(quoted(f"new column {n}"))), F.lit(name))
            for n, name in enumerate(names)
        )
    ).cast("array<string>")
    return wide.select(
        *(F.col(quoted(f"id {i}")).alias(k) for k, i in zip(keys, ids)),
        "change",
        F.when(F.col("change") == CHANGED, F.array_compact(changed)).alias("columns"),
    )


def _comparable(name: str, kind: T.DataType) -> Column:
    """Maps and variants can be neither compared nor hashed; their text can."""
    column = F.col(quoted(name))
    return F.to_json(column) if isinstance(kind, (T.MapType, T.VariantType)) else column
