"""Date-partitioned snapshots, dated exports, and the folder for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_DATE = "EVENT_DATE"

# Characters that Spark escapes in the names of partition folders.
PATH_ESCAPES = "\"#%'*/:=?\\\x7f{[]^"

# Rows of a part file of a report.
MAX_ROWS_PER_FILE = 1_000_000


def write_snapshot(
    df: DataFrame, path: str, date_column: str = EVENT_DATE, dates: Iterable[str] = ()
) -> None:
    """Write each date of ``df`` as one partition and replace what it held before.

    Writing a date again (a rerun, a retry) leaves it as if written once; other dates stay. ``dates``
    are the dates the run is about: those that ``df`` has no rows of are cleared as well. Rows are
    evened out before the write: a date with many rows is split over several files and tasks, small
    ones are put together. ``df`` is computed once; which of ``dates`` it has is seen by their files.
    """
    spark = df.sparkSession
    folders = [f"{path.rstrip('/')}/{date_column}={quote(str(date))}" for date in sorted(set(dates))]
    before = [children(spark, folder) for folder in folders]
    (
        df.hint("rebalance", F.col(date_column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )
    for folder, files in zip(folders, before):
        # Files of a write have names of their own, so an equal list was not written.
        if children(spark, folder) == files:
            remove(spark, folder)


def lay_out(df: DataFrame, table: str, key: str, buckets: int, folder: str) -> DataFrame:
    """Write a table bucketed and sorted by the key, one file per bucket, below the folder; read it.

    The table is replaced if there is one of its name.
    """
    laid = df.repartition(buckets, F.col(key))
    writer = laid.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{folder.rstrip('/')}/{table}").saveAsTable(table)
    return df.sparkSession.table(table)


def quote(value: str) -> str:
    """A partition value as it stands in a folder's name."""
    return "".join(f"%{ord(c):02X}" if c in PATH_ESCAPES or ord(c) < 32 else c for c in value)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Hadoop knows, sorted; none if there is no folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Hadoop knows; one that is absent is fine."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def export_report(
    df: DataFrame,
    folder: str,
    name: str,
    stamp: str,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
    even: bool = False,
) -> str:
    """Write ``df`` as CSV with a header to the folder ``<name> - <stamp>`` and return its path.

    The report is a folder of part files, written by all tasks: nothing passes through one task. ``even``:
    ``df`` is read from files that were evened out, so its rows are written by the tasks that read them.
    """
    path = f"{folder.rstrip('/')}/{name} - {stamp}"
    rows = df if even else df.hint("rebalance")
    (
        rows.write.mode("overwrite")
        .options(
            header=True,
            maxRecordsPerFile=max_rows_per_file,
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there, as with checkpoint().
    Unlike a checkpoint, the columns that are not asked for are not read again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see, as the session's ``spark.checkpoint.dir`` names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")
