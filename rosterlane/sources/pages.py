"""Landed JSON pages: each holds an array of records and a token of the next page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.operators.columns import quoted
from rosterlane.sources.chains import NEXT_TOKEN, PAGE_TOKEN

# Holds the text of a page that is no valid document, and is null for all others.
BROKEN = "broken page"


def page_schema(
    records: str,
    record: T.StructType,
    parents: Sequence[str] = (),
    keep_broken: bool = False,
    tokens: bool = False,
) -> T.StructType:
    """Schema of a page; ``parents`` are ids of what was asked for, from the body or the path.

    ``tokens``: pages say with which token they were asked for; ``keep_broken``: see ``read_pages``.
    """
    schema = T.StructType([T.StructField(records, T.ArrayType(record))])
    schema.add(NEXT_TOKEN, T.StringType())
    for text in (*parents, *([PAGE_TOKEN] if tokens else []), *([BROKEN] if keep_broken else [])):
        schema.add(text, T.StringType())
    return schema


def read_pages(
    spark: SparkSession,
    path: str,
    records: str,
    record: T.StructType,
    parents: Sequence[str] = (),
    multi_line: bool = False,
    keep_broken: bool = False,
    tokens: bool = False,
) -> DataFrame:
    """Pages of a folder, one JSON document per line (or per file with ``multi_line``).

    All pages are read in one scan. Parent ids may be fields of the document or folders such as
    ``webinar_id=123``. A page that is no valid JSON, or has another type where the array belongs,
    raises; with ``keep_broken`` it is a row without records, its text in the column BROKEN and its
    parents as far as they can be made out in it.
    """
    schema = page_schema(records, record, parents, keep_broken, tokens)
    pages = spark.read.schema(schema).options(**_mode(keep_broken), multiLine=multi_line).json(path)
    return _with_broken(pages, records, parents) if keep_broken else pages


def parse_pages(
    df: DataFrame,
    page: str,
    records: str,
    record: T.StructType,
    parents: Sequence[str] = (),
    keep_broken: bool = False,
    tokens: bool = False,
) -> DataFrame:
    """Pages that are a text column of a table instead of files."""
    schema = page_schema(records, record, parents, keep_broken, tokens)
    parsed = F.from_json(F.col(quoted(page)), schema, _mode(keep_broken))
    pages = df.select(parsed.alias("page")).select("page.*")
    return _with_broken(pages, records, parents) if keep_broken else pages


def _mode(keep_broken: bool) -> dict[str, str]:
    if not keep_broken:
        return {"mode": "FAILFAST"}
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}


def _with_broken(pages: DataFrame, records: str, parents: Sequence[str]) -> DataFrame:
    """Tie the broken text to the records, and add the parents of broken pages where it names them.

    A reader that is not asked for the records does not look at them, and a page with anything but an
    array there would pass for sound. No array has a size below -1, but the optimizer doesn't know.
    """
    text = F.when(F.size(F.col(quoted(records))) < -1, F.lit("")).otherwise(F.col(quoted(BROKEN)))
    tied = pages.withColumn(BROKEN, text)

    def found(parent: str) -> Column:
        named = F.regexp_extract(F.col(quoted(BROKEN)), rf'"{parent}"\s*:\s*"?([^",}}\]]+)', 1)
        return F.coalesce(F.col(quoted(parent)), F.nullif(F.btrim(named), F.lit("")))

    return tied.withColumns({parent: found(parent) for parent in parents}) if parents else tied


def explode_records(
    pages: DataFrame, records: str, parents: Sequence[str] = (), outer: bool = False
) -> DataFrame:
    """One row per record with its parents' ids.

    A page without the array has no records; with ``outer`` it gives one row of nulls.
    """
    explode = F.explode_outer if outer else F.explode
    return pages.select(
        *(F.col(quoted(p)) for p in parents), explode(F.col(quoted(records))).alias("record")
    ).select(*(F.col(quoted(p)) for p in parents), "record.*")
