"""Text predicates, whitespace handling and value-to-text conversion."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# All Unicode whitespace, not only the U+0020 that ``trim`` removes.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def trim_ws(column: Column) -> Column:
    """Strip every kind of Unicode whitespace from both ends."""
    return F.btrim(column, F.lit(WHITESPACE))


def is_blank(column: Column) -> Column:
    """True for null, for empty text and for text of whitespace only; never null."""
    return column.isNull() | F.coalesce(trim_ws(column) == "", F.lit(False))


def contains_ci(column: Column, part: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(column).contains(part.lower())


def any_of(column: Column, values: Iterable[str]) -> Column:
    """Disjunction of equalities, pushed down to the scan as ``In``."""
    return column.isin(*values)


def python_text(column: Column, data_type: T.DataType, null_text: str = "nan") -> Column:
    """Text as ``str`` prints the value: True/False, 1234567890.0, 1e+16; null becomes a label."""
    if isinstance(data_type, T.BooleanType):
        text = F.when(column, "True").when(~column, "False")
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        text = _double_text(column.cast("double"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(null_text))


def _double_text(number: Column) -> Column:
    size = F.abs(number)
    short = number.cast("string")
    # Below 1e16 the plain decimal notation is used; 21 places hold 17 digits from 1e-4 on.
    plain = F.rtrim(
        F.when((size >= 1e-4) & (size < 1e16), number).cast(T.DecimalType(38, 21)).cast("string"),
        F.lit("0"),
    )
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(short, "E", 1), r"\.0$", "")
    exponent = F.substring_index(short, "E", -1).try_cast("int")
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.when(F.abs(exponent) < 10, "0").otherwise(""),
        F.abs(exponent).cast("string"),
    )
    return (
        F.when(F.isnan(number), "nan")
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), short)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )
