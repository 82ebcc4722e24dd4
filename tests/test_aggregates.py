import random

from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.operators import conditional_distinct, distinct_concat, marks_by_key


def test_distinct_concat(spark):
    data = [("k", "B", "x"), ("k", "A", None), ("k", "B", "x"), (None, "C", "y"), ("l", None, "z")]
    df = spark.createDataFrame(data, "key string, p string, w string")
    got = distinct_concat(df, "key", {"p": "payers", "w": "waves"})
    assert rows(got) == [("k", "A, B", "x"), ("l", None, "z")]


def test_distinct_concat_sorts_by_code_point(spark):
    df = spark.createDataFrame([(1, v) for v in ("b", "B", "é", "a b", "Z")], "key int, p string")
    assert rows(distinct_concat(df, "key", {"p": "p"})) == [(1, "B, Z, a b, b, é")]


def test_conditional_distinct(spark):
    data = [("k1", False), ("k1", True), ("k2", False), (None, True)]
    df = spark.createDataFrame(data, "k string, p boolean")
    got = conditional_distinct(df, "k", {"all": None, "pred": F.col("p"), "text": "not p"})
    assert rows(got) == [(2, 1, 2)]
    assert rows(conditional_distinct(df.where("false"), "k", {"all": None})) == [(0,)]


def test_many_marks_equal_brute_force(spark):
    pick = random.Random(1)
    data = [(pick.choice([None, *range(30)]), pick.choice([None, *range(200)])) for _ in range(400)]
    df = spark.createDataFrame(data, "k int, v int").repartition(4)
    names = [f"m{n}" for n in range(100)]
    marks = {name: f"v = {n} or v > {2 * n + 90}" for n, name in enumerate(names)}
    known = [(k, v) for k, v in data if k is not None]

    def holds(v, n):
        return v is not None and (v == n or v > 2 * n + 90)

    expected = [len({k for k, v in known if holds(v, n)}) for n in range(100)]
    assert list(conditional_distinct(df, "k", marks).first()) == expected
    flags = {r[0]: list(r)[1:] for r in marks_by_key(df, "k", marks).collect()}
    assert flags == {
        key: [any(k == key and holds(v, n) for k, v in known) for n in range(100)]
        for key in {k for k, _ in known}
    }


def test_one_shuffle_of_rows_and_no_copy_per_metric(spark):
    df = spark.range(100).selectExpr("id % 7 as k", "id as v")
    metrics = {f"m{n}": f"v = {n}" for n in range(45)}
    text = plan(conditional_distinct(df, "k", metrics))
    assert "Expand" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Exchange SinglePartition") == 1


def test_distinct_values_are_made_distinct_before_they_are_gathered(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id % 5 as p")
    text = plan(distinct_concat(df, "k", {"p": "ps"})).split("Initial Plan")[0]
    exchanges = [line for line in text.split("\n") if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and "value 0" in exchanges[1]
    assert rows(distinct_concat(df, "k", {"p": "ps"})) == [(k, "0, 1, 2, 3, 4") for k in range(3)]
