"""Aggregations per key and over the whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.operators.columns import quoted
from rosterlane.operators.skew import not_null

# Marks packed into one number. More would fit, but the generated code that updates a word has to
# stay small enough for the JVM to compile it: 45 marks took 1 s with 8 per word, 5 s in one.
MARKS_PER_WORD = 8


def marks_by_key(df: DataFrame, key: str, marks: Mapping[str, Column | str]) -> DataFrame:
    """One row per non-null key; per predicate (a column or SQL text) a boolean: does it hold for
    any row of the key?

    The predicates are packed into the bits of a few numbers, which is all that is kept and shuffled
    per key and task, however many marks there are.
    """
    names = list(marks)
    words = [names[i : i + MARKS_PER_WORD] for i in range(0, len(names), MARKS_PER_WORD)]
    bits = [[f"if({quoted(n)}, {1 << j}, 0)" for j, n in enumerate(word)] for word in words]
    predicates = (
        F.expr(f"{p} as {quoted(n)}") if isinstance(p, str) else p.alias(n)
        for n, p in marks.items()
    )
    return (
        df.where(not_null([key]))
        .select(quoted(key), *predicates)
        .groupBy(quoted(key))
        .agg(*(F.expr(f"bit_or({' | '.join(b)})").alias(f"word_{i}") for i, b in enumerate(bits)))
        .selectExpr(
            quoted(key),
            *(
                f"word_{i} & {1 << j} <> 0 as {quoted(n)}"
                for i, word in enumerate(words)
                for j, n in enumerate(word)
            ),
        )
    )


def conditional_distinct(
    df: DataFrame, key: str, metrics: Mapping[str, Column | str | None]
) -> DataFrame:
    """One row: per metric the number of distinct non-null keys with a row for which it holds.

    None counts all keys. Exact, with one shuffle of one row per key and task.
    """
    marks = {n: "true" if p is None else p for n, p in metrics.items()}
    return marks_by_key(df, key, marks).selectExpr(
        *(f"count_if({quoted(name)}) as {quoted(name)}" for name in metrics)
    )


def distinct_concat(
    df: DataFrame, key: str | Sequence[str], columns: Mapping[str, str], separator: str = ", "
) -> DataFrame:
    """Per non-null key the distinct values of each column, sorted and joined to one text.

    ``columns`` maps column to result name. Nulls are left out; a key without any value gets null.
    Each row becomes one (key, column, value) per column, and these are made distinct, with the work
    of a hot key spread over its values; what its text has to hold meets in one task, and no more.
    """
    keys = [quoted(k) for k in ([key] if isinstance(key, str) else key)]
    known = df.where(not_null([key] if isinstance(key, str) else key))
    names = [f"value {i}" for i in range(len(columns))]
    entries = (
        "named_struct("
        + ", ".join(
            f"'{name}', {quoted(column) if name == shown else f'if(true, null, {quoted(column)})'}"
            for name, column in zip(names, columns)
        )
        + ")"
        for shown in names
    )
    single = known.selectExpr(*keys, f"inline(array({', '.join(entries)}))").distinct()
    # A set would let the optimizer drop the distinct; a list needs it.
    gathered = {
        result: F.sort_array(F.collect_list(name)) for name, result in zip(names, columns.values())
    }
    texts = (
        F.when(F.size(values) > 0, F.array_join(values, separator)).alias(result)
        for result, values in gathered.items()
    )
    return single.groupBy(*keys).agg(*texts)
