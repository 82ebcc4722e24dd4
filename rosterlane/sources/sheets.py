"""Sheets saved as CSV, bound to a schema by the names in their header lines.

Every file has its own header line, and files of one folder may differ: columns in another order, more
of them or fewer. Files with the same line are one layout and are read by one scan, with the columns
where that line has them; what the schema does not name is never parsed, what the line does not name
is null.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.operators.columns import quoted

BYTE_ORDER_MARK = "﻿"
# The first record of a file: line breaks within quotes belong to it.
FIRST_RECORD = r'^((?:[^"\r\n]|"(?:[^"]|"")*")*)'


def header_lines(spark: SparkSession, path: str, line_breaks: bool) -> DataFrame:
    """(file, header): the header line of each file of the folder, read as data.

    Of a split file only the first block is looked at; with ``line_breaks``, where a file is one piece
    for the reader anyway, the whole record.
    """
    file = F.col("_metadata.file_path").alias("file")
    if line_breaks:
        whole = spark.read.text(path, wholetext=True)
        return whole.select(file, F.regexp_extract("value", FIRST_RECORD, 1).alias("header"))
    lines = spark.read.text(path).where("_metadata.file_block_start = 0")
    # Blank lines before the header are no header for the reader either.
    numbered = lines.where(F.trim("value") != "").select(
        file, "value", F.monotonically_increasing_id().alias("line")
    )
    return numbered.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def header_names(header: str) -> list[str]:
    """The names of a header line; a name that comes again gets a number, as ``x.1``."""
    cells = next(csv.reader(io.StringIO(header.removeprefix(BYTE_ORDER_MARK), newline="")), [])
    seen: dict[str, int] = {}
    names = []
    for cell in cells:
        again = seen.get(cell, 0)
        seen[cell] = again + 1
        names.append(f"{cell}.{again}" if again else cell)
    return names


def layout_schema(names: Sequence[str], schema: T.StructType) -> T.StructType:
    """A column per place in the file: declared ones by name and type, others as text by number."""
    declared = {f.name: f.dataType for f in schema}
    layout = T.StructType()
    for place, name in enumerate(names):
        kind = declared.get(name)
        layout.add(name if kind is not None else f"column {place}", kind or T.StringType())
    return layout


def read_sheets(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    line_breaks: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """All rows of the files, with the columns of ``schema``, by name.

    Names are compared exactly; of a name that a line has twice the first counts. A file that lacks one
    of the ``required`` columns raises, and so does a value that does not fit its declared type. Empty
    files have no rows. To the driver come the distinct header lines and, only where a folder has more
    than one, which files have which.
    """
    headers = header_lines(spark, path, line_breaks).where(F.trim("header") != "")
    lines = [row["header"] for row in headers.select("header").distinct().collect()]
    parts = []
    for line in sorted(lines):
        names = header_names(line)
        absent = [name for name in required if name not in names]
        if absent:
            raise ValueError(f"a sheet of {path} has no column {', '.join(absent)}")
        layout = layout_schema(names, schema)
        # The line itself is the schema of its files, so the reader has nothing left to compare.
        sheet = (
            spark.read.schema(layout)
            .options(header=True, mode="FAILFAST", enforceSchema=True, escape='"', multiLine=line_breaks)
            .csv(path)
        )
        if len(lines) > 1:
            files = [row["file"] for row in headers.where(F.col("header") == line).select("file").collect()]
            sheet = sheet.where(F.col("_metadata.file_path").isin(files))
        parts.append(sheet.select(*(_column(f, names) for f in schema)))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, parts)


def _column(field: T.StructField, names: Sequence[str]) -> Column:
    if field.name in names:
        return F.col(quoted(field.name))
    return F.lit(None).cast(field.dataType).alias(field.name)


