"""Row-local operators on columns, and the union of ragged records. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.fixed_values import MISSING_TEXT
from rosterlane.functions.text import python_text


def quoted(name: str) -> str:
    """Column name safe for names with dots."""
    return "`" + name.replace("`", "``") + "`"


def fold(spark: SparkSession) -> Callable[[str], str]:
    """What two column names have in common when the session takes them for the same."""
    exact = spark.conf.get("spark.sql.caseSensitive").lower() == "true"
    return str if exact else str.lower


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by mapping; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def ensure_columns(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Add each column that is absent, as null of the given type; present ones stay as they are."""
    same = fold(df.sparkSession)
    present = {same(c) for c in df.columns}
    absent = {
        name: F.lit(None).cast(kind) for name, kind in columns.items() if same(name) not in present
    }
    return df.withColumns(absent) if absent else df


def stringify_all(
    df: DataFrame, null_text: str = MISSING_TEXT, keep: Iterable[str] = ()
) -> DataFrame:
    """Every column as text (see ``python_text``), except those in ``keep``."""
    converted = [f for f in df.schema if f.name not in set(keep)]
    texts = [f.name for f in converted if isinstance(f.dataType, T.StringType)]
    others = {
        f.name: python_text(F.col(quoted(f.name)), f.dataType, null_text)
        for f in converted
        if f.name not in texts
    }
    df = df.withColumns(others) if others else df
    return df.fillna(null_text, subset=texts) if texts else df


def questions_to_columns(
    df: DataFrame, answers: str, titles: Mapping[str, str], drop: bool = True
) -> DataFrame:
    """One column per wanted question title out of an array of (title, value).

    ``titles`` maps title to column name. The last answer to a title wins; an absent title, an
    empty array and a null array give null. A column of the same name is overwritten.
    """

    def last_answer(title: str):
        given = F.filter(F.col(quoted(answers)), lambda answer: answer["title"] == title)
        return F.try_element_at(given, F.lit(-1))["value"]

    flat = df.withColumns({name: last_answer(title) for title, name in titles.items()})
    return flat.drop(answers) if drop and answers not in titles.values() else flat


def union_ragged(*frames: DataFrame) -> DataFrame:
    """All rows of frames with differing columns, duplicates kept; what is missing is null."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)
