from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.operators import (
    ensure_columns,
    questions_to_columns,
    rename_columns,
    stringify_all,
    union_ragged,
)

ANSWERS = "array<struct<title:string,value:string>>"


def test_rename(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b ` int")
    assert rename_columns(df, {"b ": "B", "absent": "x"}).columns == ["a", "B"]


def test_ensure_columns(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    added = ensure_columns(df, {"status_y": "string", "a": "string"})
    assert added.dtypes == [("a", "int"), ("status_y", "string")]
    assert rows(added) == [(1, None), (2, None)]


def test_stringify_all(spark):
    df = spark.createDataFrame(
        [(True, 1234567890.0, None, 7, None), (False, None, "x", None, 3)],
        "flag boolean, `a.b` double, text string, number int, kept bigint",
    )
    text = stringify_all(df, keep=["kept"])
    assert text.columns == df.columns
    assert rows(text) == [("False", "nan", "x", "nan", 3), ("True", "1234567890.0", "nan", "7", None)]


def test_questions_to_columns(spark):
    data = [
        (1, [("T", "1"), ("T", "2"), ("Other.", "x")]),
        (2, []),
        (3, None),
        (4, [("Other.", None), (None, "y"), ("T", "3")]),
    ]
    df = spark.createDataFrame(data, f"id int, custom_questions {ANSWERS}")
    flat = questions_to_columns(df, "custom_questions", {"T": "tax", "Other.": "other"})
    assert flat.columns == ["id", "tax", "other"]
    assert rows(flat) == [(1, "2", "x"), (2, None, None), (3, None, None), (4, "3", None)]


def test_questions_overwrite_a_column_of_the_same_name(spark):
    df = spark.createDataFrame([("base", [("id", "answer")])], f"id string, q {ANSWERS}")
    assert rows(questions_to_columns(df, "q", {"id": "id"})) == [("answer",)]


def test_union_ragged(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a")], "id int, x string")
    other = spark.createDataFrame([(2, 5.0)], "id int, y double")
    assert rows(union_ragged(one, other)) == [(1, "a", None), (1, "a", None), (2, None, 5.0)]


def test_row_local_operators_do_not_shuffle(spark):
    df = spark.range(10).select("id", F.lit(None).cast(ANSWERS).alias("q"))
    df = stringify_all(ensure_columns(questions_to_columns(df, "q", {"T": "tax"}), {"s": "int"}))
    assert "Exchange" not in plan(df) and "Python" not in plan(df)


def test_present_columns_stay_whatever_their_case(spark):
    df = spark.createDataFrame([(1, "a")], "id int, STATUS_Y string")
    assert rows(ensure_columns(df, {"status_y": "string", "n": "int"})) == [(1, "a", None)]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert ensure_columns(df, {"status_y": "string"}).columns == ["id", "STATUS_Y", "status_y"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
