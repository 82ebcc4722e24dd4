"""Identifier clean-up and tolerant number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.functions.text import WHITESPACE


def normalize_id(column: Column, data_type: T.DataType | None = None) -> Column:
    """Identifier text without dashes and whitespace.

    Text is the default. For a numeric column pass its type: the value is cut to an integer and
    written as text. Null (and NaN) stays null, so it never matches anything.
    """
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column.cast("bigint").cast("string"))
    if isinstance(data_type, T.DecimalType):
        return column.cast("bigint").cast("string")
    if isinstance(data_type, T.NumericType):
        return column.cast("string")
    return F.translate(column, "-" + WHITESPACE, "")


def id_as_int_text(column: Column, strict: bool = True, width: int | None = None) -> Column:
    """Identifier as integer text, which loses leading zeros; ``width`` pads them back.

    Malformed text raises, or becomes null when ``strict`` is off.
    """
    number = column.cast("bigint") if strict else column.try_cast("bigint")
    text = number.cast("string")
    if width is None:
        return text
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def to_number(column: Column) -> Column:
    """Whole number, or null when the text is not one."""
    return column.try_cast("bigint")
