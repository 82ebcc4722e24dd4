import datetime
import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.operators import fill_within_group, first_per_key, ranked_first
from rosterlane.operators.ordered import BACKWARD, FORWARD
from rosterlane.fixed_values import ROLE_HIERARCHY, ROLE_PART
from rosterlane.functions import role_rank

FORWARD_ROWS = [("a", None, 0), ("a", 1, 1), ("a", None, 2), (None, 5, 3), ("b", None, 4)]
BACKWARD_ROWS = [("a", None, 0), ("a", 1, 1), ("a", None, 2), ("a", 3, 3), ("a", None, 4)]


def fill(spark, data, mode, **options):
    df = spark.createDataFrame(data, "k string, v int, i bigint")
    filled = fill_within_group(df, "k", {"v": mode}, ["i"], **options)
    assert filled.columns == ["k", "v", "i"]
    return [r.v for r in filled.orderBy("i").collect()]


@pytest.mark.parametrize("hot_rows", [1, 2, 1000])
def test_fill_fixtures(spark, hot_rows):
    assert fill(spark, FORWARD_ROWS, FORWARD, hot_rows=hot_rows) == [1, 1, 1, None, None]
    assert fill(spark, BACKWARD_ROWS, BACKWARD, hot_rows=hot_rows) == [1, 1, 3, 3, 3]
    assert fill(spark, BACKWARD_ROWS, FORWARD, hot_rows=hot_rows) == [1, 1, 1, 3, 3]


def filled_by_hand(values, mode):
    """Values of one group in order, filled."""
    steps = values if mode == FORWARD else values[::-1]
    known = [v for v in steps if v is not None]
    result, last = [], known[0] if known else None
    for value in steps:
        last = value if value is not None else last
        result.append(last)
    return result if mode == FORWARD else result[::-1]


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("hot_rows", [3, 7, 1000])
def test_fill_equals_brute_force(spark, hot_rows, kind):
    pick = random.Random(hot_rows)
    # One group has a third of the rows, another part has no group; orders are sparse and uneven.
    data, expected = [], []
    sizes = {"hot": 120, None: 40, **{f"g{i}": pick.randrange(1, 25) for i in range(16)}}
    for group, size in sizes.items():
        places = sorted(pick.sample(range(-500, 2000), size))
        if group == "hot":
            places = places[:-1] + [100000]
        a = [pick.choice([None, None, None, pick.randrange(99)]) for _ in places]
        b = [pick.choice([None, None, None, None, str(pick.randrange(99))]) for _ in places]
        filled_a, filled_b = filled_by_hand(a, FORWARD), filled_by_hand(b, BACKWARD)
        for i, place in enumerate(places):
            data.append((group, a[i], b[i], place))
            known = group is not None
            expected.append((group, place, filled_a[i] if known else None, filled_b[i] if known else None))
    df = spark.createDataFrame(data, "g string, a int, b string, place int").repartition(5)
    place = F.col("place")
    order = {
        "bigint": place.cast("bigint"),
        "double": place / 7,
        "date": F.date_add(F.lit(datetime.date(2020, 1, 1)), place),
        "timestamp": F.timestamp_seconds(place * 1800),
        "timestamp_ntz": F.timestamp_seconds(place * 1800).cast("timestamp_ntz"),
    }[kind]
    filled = fill_within_group(
        df.withColumn("o", order), "g", {"a": FORWARD, "b": BACKWARD}, ["o"], hot_rows=hot_rows
    )
    assert rows(filled, "g", "place", "a", "b") == sorted(expected, key=repr)


def test_hot_groups_are_cut(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "if(id % 50 = 0, id, null) as v", "id as i")
    from rosterlane.operators.ordered import _cut_into_runs

    runs = _cut_into_runs(df, ["g"], ["i"], 100).groupBy("g", "fill run").count()
    assert runs.agg(F.max("count")).first()[0] <= 100
    assert runs.count() >= 10


def test_runs_are_even_in_rows_whatever_the_order(spark):
    from rosterlane.operators.ordered import _cut_into_runs

    df = spark.range(1000).selectExpr("1 as g", "id as i")
    orders = {
        "one value far out": "if(i = 5, 1000000000000, i)",
        "fractions": "cast(i as double) / 1000000",
        "no value": "cast(null as double)",
        "ties": "i % 2",
        "text": "cast(i as string)",
    }
    for name, order in orders.items():
        cut = _cut_into_runs(df.selectExpr("*", f"{order} as o"), ["g"], ["o", "i"], 100)
        runs = cut.groupBy("fill run").agg(F.count("*").alias("n"), F.min("o"), F.max("o"))
        assert runs.agg(F.max("n")).first()[0] <= 200, name
        assert runs.count() >= 10, name
        late = cut.alias("a").join(cut.alias("b"), F.expr("a.`fill run` < b.`fill run`"))
        assert late.where("struct(a.o, a.i) >= struct(b.o, b.i)").count() == 0, name


def test_tasks_of_a_cut_do_not_grow_with_the_runs(spark):
    """Runs are as many as the rows ask for, the tasks that cut them no more than shuffle partitions."""
    from rosterlane.operators.ordered import _cut_into_runs

    df = spark.range(4000).selectExpr("1 as g", "id as i")
    cut = _cut_into_runs(df, ["g"], ["i"], 20)
    assert cut.rdd.getNumPartitions() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = cut.groupBy("fill run").agg(F.count("*").alias("n"), F.min("i").alias("a"), F.max("i").alias("b"))
    assert runs.count() >= 400 and runs.agg(F.max("n")).first()[0] <= 10
    assert runs.where("b - a + 1 <> n").count() == 0


def test_a_hot_group_is_never_gathered(spark, monkeypatch):
    """Neither its rows nor its cuts come together in one row or one broadcast."""
    df = spark.range(2000).selectExpr("if(id % 3 = 0, 1, id) as g", "if(id % 50 = 0, id, null) as v", "id as i")
    filled = fill_within_group(df, "g", {"v": FORWARD}, ["i"], hot_rows=50)
    text = plan(filled)
    assert "collect_list" not in text
    for part in text.split("BroadcastExchange")[1:]:
        assert "ExistingRDD" in next(line for line in part.split("\n") if "Scan" in line)
    assert filled.count() == 2000 and filled.where("g = 1 and v is null").count() == 0


def test_fill_by_an_order_of_text(spark):
    data = [("a", None, "c"), ("a", 1, "b"), ("a", None, "a"), ("a", 2, "d")]
    df = spark.createDataFrame(data, "g string, v int, o string")
    filled = fill_within_group(df, "g", {"v": FORWARD}, ["o"], hot_rows=2)
    assert rows(filled, "o", "v") == [("a", 1), ("b", 1), ("c", 1), ("d", 2)]


def test_fill_keeps_columns_with_any_name(spark):
    df = spark.createDataFrame([("a", None, 0, 9), ("a", 1, 1, 8)], "run string, at int, seq int, is_hot int")
    filled = fill_within_group(df, "run", {"at": FORWARD}, ["seq"], hot_rows=1)
    assert rows(filled) == [("a", 1, 0, 9), ("a", 1, 1, 8)]


def test_fill_by_two_group_columns(spark):
    data = [("a", 1, None, 0), ("a", 1, 5, 1), ("a", 2, None, 2), (None, 1, 7, 3)]
    df = spark.createDataFrame(data, "g string, h int, v int, i int")
    filled = fill_within_group(df, ["g", "h"], {"v": FORWARD}, ["i"], hot_rows=1)
    assert [r.v for r in filled.orderBy("i").collect()] == [5, 5, None, None]


def test_what_follows_a_fill_per_group_needs_no_shuffle(spark):
    data = [(1, 7, 1), (1, None, 2), (1, 8, 3), (2, None, 1), (None, 5, 1), (None, None, 2)]
    df = spark.createDataFrame(data, "g int, v int, i int")
    filled = fill_within_group(df, "g", {"v": FORWARD}, ["i"])
    assert rows(filled, "g", "i", "v") == rows(
        spark.createDataFrame(
            [(1, 1, 7), (1, 2, 7), (1, 3, 8), (2, 1, None), (None, 1, None), (None, 2, None)],
            "g int, i int, v int",
        )
    )
    first = first_per_key(filled, ["g", "v"], ["i"])
    assert rows(first.where("g = 1"), "v", "i") == [(7, 1), (8, 3)]
    assert plan(first).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_first_per_key_treats_null_keys_as_equal(spark):
    data = [(None, 1, 1), (None, 1, 2), ("a", 1, 3), ("a", 1, 4)]
    df = spark.createDataFrame(data, "k string, w int, seq int")
    assert rows(first_per_key(df, ["k", "w"], ["seq"]), "seq") == [(1,), (3,)]


def test_first_per_key_breaks_ties_by_the_other_columns(spark):
    data = [("a", 1, "z"), ("a", 1, "y"), ("a", 2, "b"), ("b", 1, None), ("b", 1, "c")]
    for parts in (1, 2, 5):
        df = spark.createDataFrame(data, "k string, seq int, v string").repartition(parts)
        assert rows(first_per_key(df, ["k"], ["seq"])) == [("a", 1, "y"), ("b", 1, None)]


def test_first_per_key_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 as k", "id as seq")
    text = plan(first_per_key(df, ["k"], ["seq"]))
    assert text.count("Exchange") == 1
    assert "WindowGroupLimit" in text[text.index("Exchange") :]


def test_ranked_first(spark):
    data = [
        ("1", "Nurse", "n@"),
        ("1", "Care Coordinator", "c@"),
        ("1", "Owner", "o@"),
        ("2", "Nurse", "z@"),
        ("2", "Guard", "y@"),
    ]
    df = spark.createDataFrame(data, "id string, role string, email string")
    rank = role_rank(F.col("role"), ROLE_HIERARCHY, ROLE_PART)
    assert rows(ranked_first(df, "id", rank, ["email"]), "id", "email") == [("1", "o@"), ("2", "y@")]
