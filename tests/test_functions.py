import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane import functions as R
from rosterlane.fixed_values import ROLE_HIERARCHY, ROLE_PART
from rosterlane.functions.roles import UNLISTED
from rosterlane.functions.text import WHITESPACE


def values(spark, kind, data, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [tuple(r) for r in df.orderBy("i").select(*expressions).collect()]


def one(spark, kind, data, expression):
    return [r[0] for r in values(spark, kind, data, expression)]



def test_normalize_id_text(spark):
    data = ["12-34 5", "12-34\u00a05", " 1\t2\n\x1c3-", "", None]
    assert one(spark, "string", data, R.normalize_id(F.col("v"))) == ["12345", "12345", "123", "", None]


def test_normalize_id_numbers(spark):
    double = R.normalize_id(F.col("v"), T.DoubleType())
    data = [123.0, 12.9, -3.7, float("nan"), None, 1234567890.0]
    assert one(spark, "double", data, double) == ["123", "12", "-3", None, None, "1234567890"]
    assert one(spark, "bigint", [7, None], R.normalize_id(F.col("v"), T.LongType())) == ["7", None]


def test_whitespace_is_what_python_strips(spark):
    data = [c + "a" + c + "b" + c for c in WHITESPACE] + ["\u200bx", "-"]
    assert one(spark, "string", data, R.trim_ws(F.col("v"))) == [d.strip() for d in data]
    stripped = ["".join(d.replace("-", "").split()) for d in data]
    assert one(spark, "string", data, R.normalize_id(F.col("v"))) == stripped


def test_blank(spark):
    data = [" x\t ", " \t", None, "x", "", "\u00a0"]
    assert one(spark, "string", data, R.is_blank(F.col("v"))) == [False, True, True, False, True, True]


def test_id_as_int_text(spark):
    data = ["012345678", "7", None]
    assert one(spark, "string", data, R.id_as_int_text(F.col("v"))) == ["12345678", "7", None]
    padded = R.id_as_int_text(F.col("v"), width=9)
    assert one(spark, "string", [*data, "1234567890"], padded) == [
        "012345678",
        "000000007",
        None,
        "1234567890",
    ]
    assert one(spark, "string", ["x1", "2"], R.id_as_int_text(F.col("v"), strict=False)) == [None, "2"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, "string", ["x1"], R.id_as_int_text(F.col("v")))


def test_role_rank(spark):
    roles = ["Administrator", "Owner", "Operations", "Care Coordinator", "Nurse", None, "owner"]
    rank = R.role_rank(F.col("v"), ROLE_HIERARCHY, ROLE_PART)
    assert one(spark, "string", roles, rank) == [0, 1, 2, 3, UNLISTED, UNLISTED, UNLISTED]
    both = R.role_rank(F.col("v"), ["Owner", "Coordinator"], "Coordinator")
    assert one(spark, "string", ["Coordinator"], both) == [2]


def test_contains_and_any_of(spark):
    data = ["The MI Roadshow", "mi roadsho", None, "100% mi roadshow"]
    found = R.contains_ci(F.col("v"), "mi roadshow")
    assert one(spark, "string", data, found) == [True, False, None, True]
    assert one(spark, "string", ["a", "b", None], R.any_of(F.col("v"), ["a", "c"])) == [True, False, None]


def test_to_number(spark):
    assert one(spark, "string", ["12", "x", None, ""], R.to_number(F.col("v"))) == [12, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_report_date_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        seconds = [1735786800, 1735794000, 1720000000]  # 2025-01-02 03:00 and 05:00, 2024-07-03
        instant = F.timestamp_seconds(F.col("v"))
        got = values(spark, "bigint", seconds, R.report_date(instant), R.export_stamp(instant))
        assert got == [
            ("01/01/2025", "2025-01-01"),
            ("01/02/2025", "2025-01-02"),
            ("07/03/2024", "2024-07-03"),
        ]
        wall = F.lit("2025-01-02 03:00:00").cast("timestamp_ntz")
        assert one(spark, "int", [1], R.report_date(wall, utc_wall=True)) == ["01/01/2025"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_report_date(spark):
    assert one(spark, "string", ["01/02/2025", None], R.parse_report_date(F.col("v"))) == [
        datetime.date(2025, 1, 2),
        None,
    ]


def test_numbers_print_as_python_prints_them(spark):
    numbers = [
        0.0, -0.0, 1.0, 7.25, 1234567890.0, 123456789.125, 0.1, 1e15, 9999999999999998.0, 1e16,
        1.5e16, 1.5e300, 1e-3, 1e-4, 1.25e-4, 1e-5, 1.5e-5, 1e-100, -1234567.5, -1e22, 1e7,
        float("inf"), float("-inf"), float("nan"),
    ]
    text = R.python_text(F.col("v"), T.DoubleType())
    assert one(spark, "double", numbers, text) == [str(n) for n in numbers]


def test_text_of_other_types(spark):
    assert one(spark, "boolean", [True, False, None], R.python_text(F.col("v"), T.BooleanType())) == [
        "True",
        "False",
        "nan",
    ]
    assert one(spark, "bigint", [7, None], R.python_text(F.col("v"), T.LongType())) == ["7", "nan"]
    assert one(spark, "string", ["a", None], R.python_text(F.col("v"), T.StringType(), "None")) == [
        "a",
        "None",
    ]


def test_booleans_are_text_without_case_mapping(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    text = df.select(R.python_text(F.col("v"), T.BooleanType()).alias("t"))
    assert "initcap" not in text._jdf.queryExecution().toString().lower()
    assert sorted(r[0] for r in text.collect()) == ["False", "True", "nan"]
