import datetime
from pathlib import Path

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.sinks import (
    export_report,
    publish_day,
    published_runs,
    read_published,
    shared_folder,
    write_snapshot,
)
from rosterlane.sinks.files import kept


def snapshot(spark, values):
    df = spark.createDataFrame(values, "id int, day string")
    return df.select("id", F.to_date("day").alias("EVENT_DATE"))


def test_a_day_written_twice_counts_once(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    write_snapshot(snapshot(spark, [(1, "2025-01-01"), (2, "2025-01-01")]), path)
    write_snapshot(snapshot(spark, [(3, "2025-01-02")]), path)
    write_snapshot(snapshot(spark, [(1, "2025-01-01"), (4, "2025-01-01")]), path)
    one, two = datetime.date(2025, 1, 1), datetime.date(2025, 1, 2)
    assert rows(spark.read.parquet(path)) == [(1, one), (3, two), (4, one)]


def test_overwrite_does_not_depend_on_the_session(spark, tmp_path):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    test_a_day_written_twice_counts_once(spark, tmp_path)


def test_dates_as_text(spark, tmp_path):
    path = str(tmp_path / "detail")
    df = spark.createDataFrame([("1", "01/02/2025"), ("2", "01/03/2025")], "id string, EVENT_DATE string")
    write_snapshot(df, path)
    write_snapshot(df, path)
    assert rows(spark.read.schema(df.schema).parquet(path)) == [
        ("1", "01/02/2025"),
        ("2", "01/03/2025"),
    ]


def test_export(spark, tmp_path):
    values = [("1", 'a "quoted", text'), ("2", "line\nbreak"), ("3", None)]
    df = spark.createDataFrame(values, "id string, text string")
    path = export_report(df, str(tmp_path), "Campaign Report", "2025-01-02")
    assert path == f"{tmp_path}/Campaign Report - 2025-01-02"
    read = spark.read.options(header=True, escape='"', multiLine=True).csv(path)
    assert rows(read) == values
    export_report(df.limit(1), str(tmp_path), "Campaign Report", "2025-01-02")
    assert spark.read.options(header=True).csv(path).count() == 1


def test_export_of_many_rows_has_several_files(spark, tmp_path):
    path = export_report(spark.range(1000), str(tmp_path), "r", "s", max_rows_per_file=100)
    files = spark.read.option("header", True).csv(path).inputFiles()
    assert len(files) >= 10
    assert spark.read.option("header", True).csv(path).distinct().count() == 1000


def test_shared_folder_is_the_one_of_the_session(spark, monkeypatch):
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder).rstrip("/")

    class Elsewhere:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Elsewhere)


def test_a_rerun_without_rows_clears_its_day(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    both = snapshot(spark, [(1, "2025-01-01"), (2, "2025-01-02")])
    write_snapshot(both, path)
    write_snapshot(both.where("false"), path, dates=["2025-01-01", "2025-01-09"])
    assert rows(spark.read.schema(both.schema).parquet(path)) == [(2, datetime.date(2025, 1, 2))]
    text = spark.createDataFrame([("1", "01/02/2025")], "id string, EVENT_DATE string")
    path = str(tmp_path / "detail")
    write_snapshot(text, path)
    write_snapshot(text.where("false"), path, dates=["01/02/2025"])
    assert rows(spark.read.schema(text.schema).parquet(path)) == []


def test_report_keeps_white_space(spark, tmp_path):
    df = spark.createDataFrame([("1", " a "), ("2", "b\t")], "id string, `name ` string")
    path = export_report(df, str(tmp_path), "R", "x")
    read = spark.read.schema(df.schema).options(header=True, escape='"').csv(path)
    assert rows(read) == rows(df)


def test_a_snapshot_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    df = snapshot(spark, [(1, "2025-01-01"), (2, "2025-01-02")])
    counted = df.rdd.map(lambda r: seen.add(1) or tuple(r)).toDF(df.schema)
    write_snapshot(counted, str(tmp_path / "s"), dates=["2025-01-01", "2025-01-03"])
    assert seen.value == 2


def test_publication(spark, tmp_path):
    store = str(tmp_path / "store")
    one, two = spark.range(3), spark.range(1).selectExpr("id as n")
    broken = two.selectExpr("cast(raise_error('gone') as bigint) as n")
    with pytest.raises(ValueError, match="any day"):
        read_published(spark, store, "a")
    assert read_published(spark, store, "a", schema=one.schema).count() == 0
    with pytest.raises(Exception, match="gone"):
        publish_day(spark, store, "d1", {"a": one, "b": broken})
    assert published_runs(spark, store, "a") == {}
    publish_day(spark, store, "d1", {"a": one, "b": two})
    publish_day(spark, store, "d 2:/%", {"a": one.where("id > 1"), "b": two.where("false")})
    reading = read_published(spark, store, "a", ["d1"])
    with pytest.raises(Exception, match="gone"):
        publish_day(spark, store, "d1", {"a": one.where("id = 0"), "b": broken})
    assert rows(reading) == [(0,), (1,), (2,)] == rows(read_published(spark, store, "a", ["d1"]))
    publish_day(spark, store, "d1", {"a": one.where("id = 0"), "b": two})
    # Who began to read before the replacement can read on.
    assert rows(reading) == [(0,), (1,), (2,)] and rows(read_published(spark, store, "a", ["d1"])) == [(0,)]
    assert rows(read_published(spark, store, "a")) == [(0,), (2,)]
    assert rows(read_published(spark, store, "b")) == [(0,)]
    with pytest.raises(ValueError, match="d3"):
        read_published(spark, store, "a", ["d1", "d3"])
    for _ in range(3):
        publish_day(spark, store, "d1", {"a": one, "b": two})
    # The run that is read and the one before it, no more.
    assert len(list((tmp_path / "store" / "a" / "d1").iterdir())) == 2
    assert len(list((tmp_path / "store" / "published" / "d1").iterdir())) <= 2


def test_rows_read_from_even_files_are_exported_where_they_are(spark, tmp_path):
    df = spark.range(1000, numPartitions=3).selectExpr("id as a", "id * 2 as b")
    path = export_report(df, str(tmp_path), "r", "s", 400, True)
    assert len(list(Path(path).glob("part-*"))) == 3
    back = spark.read.option("header", True).csv(path)
    assert back.count() == back.distinct().count() == 1000


def test_what_is_kept_is_read_by_column(spark):
    df = spark.createDataFrame([(1, "x", None), (None, "y", True)], "`a b` int, c string, d boolean")
    back = kept(df, "rows")
    assert rows(back) == rows(df) and back.schema == df.schema
    assert "ReadSchema: struct<c:string>" in plan(back.select("c"))
