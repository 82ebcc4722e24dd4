import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.operators import (
    exists_flag,
    keep_matching,
    left_join,
    lookup_override,
    merge_suffixed,
)
from rosterlane.operators.skew import gridded, hot_parts, spread


def test_exists_flag(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    ref = spark.createDataFrame([("1",), ("1",), (None,)], "key string")
    got = exists_flag(df, ref, "id", "key", flag="created")
    assert rows(got) == [("1", True), ("2", False), (None, False)]


def test_exists_flag_replaces_a_flag_of_the_same_name(spark):
    df = spark.createDataFrame([("1", True), ("2", True)], "id string, seen boolean")
    ref = spark.createDataFrame([("1",)], "id string")
    assert rows(exists_flag(df, ref, "id", flag="seen")) == [("1", True), ("2", False)]


def test_reference_is_made_unique_before_the_shuffle(spark):
    ref = spark.range(100).select((F.col("id") % 3).alias("key"))
    df = spark.range(10)
    text = plan(exists_flag(df, ref, "id", "key", even=True))
    first = text.index("HashAggregate(keys=[match 0")
    shuffle = text.index("Exchange", first)
    assert text.index("HashAggregate(keys=[match 0", first + 1) > shuffle


@pytest.mark.parametrize("hot_rows", [20, 1000])
def test_a_join_reads_each_side_once_and_broadcasts_no_table(spark, tmp_path, hot_rows):
    path = str(tmp_path)
    key = "case when id % 3 = 0 then 7 when id % 5 = 0 then id end as k"
    spark.range(100).selectExpr(key, "id as n").write.parquet(f"{path}/left")
    spark.range(50).selectExpr("id as key", "id * 2 as v").write.parquet(f"{path}/right")
    left, right = spark.read.parquet(f"{path}/left"), spark.read.parquet(f"{path}/right")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cases = {
            "left_join": left_join(left, right, "k", "key", unique=True, hot_rows=hot_rows),
            "fan out": left_join(left, right, "k", "key", hot_rows=hot_rows),
            "exists_flag": exists_flag(left, right, "k", "key", hot_rows=hot_rows),
            "keep_matching": keep_matching(left, right, "k", "key", hot_rows=hot_rows),
            "lookup_override": lookup_override(left, right, "k", "n", "v", mapping_on="key", hot_rows=hot_rows),
        }
        for name, df in cases.items():
            df.collect()
            final = plan(df).split("Initial Plan")[0]
            scans = [line for line in final.split("\n") if "FileScan" in line]
            assert sum("/left]" in line for line in scans) == 1, name
            assert sum("/right]" in line for line in scans) == 1, name
            # What is broadcast is the list of hot keys; without any, the join is a plain one.
            broadcasts = final.split("BroadcastExchange")[1:]
            assert bool(broadcasts) == (hot_rows == 20), name
            for part in broadcasts:
                leaves = [line for line in part.split("\n") if "Scan" in line]
                assert not leaves or "FileScan" not in leaves[0], name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_dealt_even_if_they_are_alike(spark):
    df = spark.range(0, 6000, 1, 12).selectExpr("if(id % 3 = 0, null, 7) as k")
    hot = hot_parts(df, ["k"], 100)
    dealt = spread(df, ["k"], hot, None, "own", "other").groupBy("k", "own").count()
    assert dealt.where("k = 7").agg(F.max("count")).first()[0] <= 4000 / 12 + 1
    assert dealt.where("k is null").count() >= 12
    wide = df.withColumn("n", F.monotonically_increasing_id())
    dealt = spread(wide, ["k"], hot, None, "own", "other").groupBy("k", "own").count()
    assert dealt.agg(F.max("count")).first()[0] <= 200


def test_repeated_rows_of_a_key_hot_on_both_sides_do_not_grow_with_the_product(spark):
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n in (1000, 4000):
        left = spark.range(n).selectExpr("if(id % 2 = 0, 1, -id - 1) as k", "id as n")
        right = spark.range(n // 5).selectExpr("if(id % 2 = 0, 1, id + 10) as r", "id as m")
        one, other = gridded(hot_parts(left, ["k"], 10), hot_parts(right, ["r"], 10), ["k"], ["r"])
        counts = [
            spread(left, ["k"], one, other, "own", "other").where("k = 1").count(),
            spread(right, ["r"], other, one, "own", "other").where("r = 1").count(),
        ]
        # 6 n / 10 rows of the key in all.
        assert sum(counts) <= cells * 6 * n / 10
        joined = left_join(left, right, "k", "r", hot_rows=10)
        assert joined.count() == n // 2 * (n // 10) + n // 2
        assert joined.where("k = 1").agg(F.countDistinct("n", "m")).first()[0] == n // 2 * (n // 10)


def test_only_keys_that_are_hot_on_both_sides_get_fewer_parts(spark):
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    left = spark.range(900 * cells).selectExpr("id % 3 as k")
    right = spark.range(60).selectExpr("cast(if(id % 2 = 0, 1, id + 10) as int) as r")
    one, other = gridded(hot_parts(left, ["k"], 10), hot_parts(right, ["r"], 10), ["k"], ["r"])
    assert rows(one.parts) == [(0, 30 * cells), (1, cells), (2, 30 * cells)]
    assert rows(other.parts) == [(1, 1)]


def test_product_of_a_key_hot_on_both_sides_takes_little_disk(spark, tmp_path):
    left = spark.range(200).selectExpr("if(id % 2 = 0, 1, -id) as k", "id * 7919 as n")
    right = spark.range(80_000).selectExpr("if(id % 2 = 0, 1, id + 10) as r", "id * 7919 as m")
    joined = left_join(left, right, "k", "r", hot_rows=10)
    # The join hands on pairs of blocks; its generated code would hold all rows that come of them.
    assert plan(joined).index("Generate inline") < plan(joined).index("Coalesce") < plan(joined).index("Join [")
    joined.write.parquet(f"{tmp_path}/joined")
    size = sum(f.stat().st_size for f in tmp_path.glob("joined/*.parquet"))
    got = spark.read.parquet(f"{tmp_path}/joined")
    assert got.where("k = 1").agg(F.count("*"), F.countDistinct("n", "m")).first() == (4_000_000, 4_000_000)
    assert got.where("k <> 1 and m is null").count() == 100 and got.count() == 4_000_100
    assert size < 4_000_000 / 2


@pytest.mark.parametrize("rows_of_a_block", [1, 3, 128])
def test_blocks_keep_rows_and_values_as_they_are(spark, monkeypatch, rows_of_a_block):
    """Keys of either type, a zero with a sign, rows that are alike, columns of odd names."""
    monkeypatch.setattr("rosterlane.operators.joins.BLOCK_ROWS", rows_of_a_block)
    left = spark.range(150).selectExpr("cast(if(id < 100, '-0.0', string(id)) as float) as `k.1`", "id % 2 as n")
    right = spark.range(150).selectExpr("cast(if(id < 90, 0, id - 20) as double) as r", "id % 3 as `m``x`")
    got = left_join(left, right, "k.1", "r", hot_rows=4)
    assert got.columns == ["k.1", "n", "r", "m`x"]
    want = [("-0.0", i % 2, 0.0, j % 3) for i in range(100) for j in range(90)]
    want += [(f"{i}.0", i % 2, float(i) if i < 130 else None, (i + 20) % 3 if i < 130 else None) for i in range(100, 150)]
    assert rows(got.withColumn("k.1", F.col("`k.1`").cast("string"))) == sorted(want, key=repr)


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_columns_of_any_type(spark, hot_rows):
    """Maps, variants, arrays and structs on both sides; none of them is a key."""
    more = ["map('a', id) as m", "parse_json('[1]') as v", "array(id) as a", "struct(id) as s"]
    left = spark.range(12).selectExpr("id", "if(id % 3 = 0, 1, if(id = 5, null, id)) as k", *more)
    right = spark.range(6).selectExpr("id % 3 as r", "id as n", "map('b', id) as rm", "parse_json('1') as rv")
    joined = left_join(left, right, "k", "r", hot_rows=hot_rows)
    got = [(r["id"], r["n"], r["m"]["a"], r["rm"]) for r in joined.orderBy("id", "n").collect()]
    want = []
    for i in range(12):
        k = 1 if i % 3 == 0 else None if i == 5 else i
        hits = [n for n in range(6) if n % 3 == k] or [None]
        want += [(i, n, i, None if n is None else {"b": n}) for n in hits]
    assert got == want
    flagged = exists_flag(left, right, "k", "r", hot_rows=hot_rows)
    assert flagged.where("exists").count() == 6 and flagged.columns == [*left.columns, "exists"]
    assert keep_matching(left, right, "k", "r", hot_rows=hot_rows).count() == 6
    named = lookup_override(left.withColumn("w", F.lit("x")), spark.createDataFrame([(1, "y")], "k int, w string"), "k", "w", "w", hot_rows=hot_rows)
    assert named.where("w = 'y'").count() == 5


def test_hot_keys_are_found_by_a_summary_of_bounded_size(spark, tmp_path):
    """A sketch per task is all that is exchanged, however many keys there are."""
    from rosterlane.operators import skew

    df = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, id) as k", "if(id % 4 = 0, null, 'x') as w")
    found = skew.hot_parts(df, ["k"], 1000)
    assert rows(found.parts) == [(7, 67)] and found.rows == 66_668 and not found.loose
    both = skew.hot_parts(df, ["k", "w"], 1000)
    assert rows(both.parts) == [(7, "x", 51)] and both.loose
    assert not skew.hot_parts(df.where("k <> 7"), ["k"], 1000)
    assert not skew.hot_parts(df.where("false"), ["k"], 1)
    summary = plan(df.selectExpr(f"approx_top_k(xxhash64(k), {skew.MOST}, {skew.TRACKED})"))
    assert "SinglePartition" in summary and "hashpartitioning" not in summary


@pytest.mark.parametrize("hot_rows", [2, 5, 1000])
def test_join_with_keys_hot_on_both_sides(spark, hot_rows):
    left = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 50), (None, 51), (9, 52)], "k int, n int")
    right = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 1), (None, 2), (3, 3)], "r int, m int")
    got = left_join(left, right, "k", "r", hot_rows=hot_rows)
    want = [(1, i, 1, j) for i in range(30) for j in range(20)]
    want += [(2, 50, 2, 1), (None, 51, None, None), (9, 52, None, None)]
    assert rows(got, "k", "n", "r", "m") == sorted(want, key=repr)


def test_repeated_keys_of_a_mapping(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    mapping = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, None), (None, "n")], "k int, w string")
    assert rows(lookup_override(df, mapping, "id", "v", "w", mapping_on="k")) == [(1, "a"), (2, "y"), (3, "z")]


def test_names_that_differ_in_case_clash(spark):
    left = spark.createDataFrame([(1, "a")], "id int, status string")
    right = spark.createDataFrame([(1, "b")], "key int, STATUS string")
    assert merge_suffixed(left, right, "id", "key").columns == ["id", "status_x", "key", "STATUS_y"]


def test_keep_matching(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (None, "a", 2), (1, "a", 3)], "k int, w string, n int")
    ref = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "k int, w string")
    assert rows(keep_matching(df, ref, ["k", "w"]), "n") == [(0,), (3,)]
    nothing = ref.where("false")
    assert rows(keep_matching(df, nothing, ["k", "w"])) == []


def test_lookup_override(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (2, " ")], "id int, email string")
    mapping = spark.createDataFrame([(2, "m"), (3, "n")], "key int, value string")
    literal = lookup_override(df, mapping, "id", "email", "value", mapping_on="key")
    assert rows(literal) == [(1, "x"), (2, "m"), (2, "m"), (3, "n")]
    blank = lookup_override(
        df, mapping, "id", "email", "value", mapping_on="key", only_blank=True
    )
    assert rows(blank) == [(1, "x"), (2, "m"), (2, "m"), (3, "y")]
    assert blank.columns == df.columns


def test_merge_suffixed_names(spark):
    left = spark.createDataFrame([("1", "approved")], "id string, status string")
    right = spark.createDataFrame(
        [("1", "9", "in_meeting")], "registrant_id string, id string, status string"
    )
    merged = merge_suffixed(left, right, "id", "registrant_id")
    assert merged.columns == ["id_x", "status_x", "registrant_id", "id_y", "status_y"]
    assert rows(merged) == [("1", "approved", "1", "9", "in_meeting")]
    plans = merge_suffixed(left, right, "id", "registrant_id", suffixes=("", "_help"))
    assert plans.columns == ["id", "status", "registrant_id", "id_help", "status_help"]


def test_merge_keeps_a_shared_key_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    right = spark.createDataFrame([(1, "c"), (1, "d")], "id int, v string")
    merged = merge_suffixed(left, right, "id")
    assert merged.columns == ["id", "v_x", "v_y"]
    assert rows(merged) == [(1, "a", "c"), (1, "a", "d"), (2, "b", None)]


def test_join_of_a_frame_with_itself(spark):
    df = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    other = df.select(F.col("a").alias("key"), F.col("b").alias("next"))
    assert rows(left_join(df, other, "b", "key")) == [(1, 2, 2, 3), (2, 3, None, None)]


@pytest.mark.parametrize("hot_rows", [1, 2, 5, 1000])
@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("even", [False, True])
def test_left_join_equals_brute_force(spark, hot_rows, unique, even):
    pick = random.Random(hot_rows)
    # A third of both sides has one key; nulls and copies of whole rows are among them.
    keys = [None, 0, 1, 2, 3, 4, 5, 6]
    weights = [3, 8, 2, 2, 2, 2, 2, 2]
    left = [(pick.choices(keys, weights)[0], pick.randrange(3)) for _ in range(60)]
    right = [(pick.choices(keys[:6], weights[:6])[0], pick.randrange(2)) for _ in range(50)]
    if unique:
        right = list({k: (k, v) for k, v in right}.values())
    expected = []
    for k, v in left:
        matches = [r for r in right if k is not None and r[0] == k]
        expected += [(k, v, *r) for r in matches] or [(k, v, None, None)]
    joined = left_join(
        spark.createDataFrame(left, "k int, v int").repartition(3),
        spark.createDataFrame(right, "rk int, rv int").repartition(3),
        "k",
        "rk",
        unique=unique,
        even=even,
        hot_rows=hot_rows,
    )
    assert rows(joined) == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_rows", [1, 5, 1000])
def test_marks_and_look_ups_equal_brute_force(spark, hot_rows):
    pick = random.Random(hot_rows)
    keys, weights = [None, 0, 1, 2, 3, 4, 5, 6], [6, 8, 2, 2, 2, 2, 2, 2]
    data = [(pick.choices(keys, weights)[0], i, pick.choice([None, " ", "v"])) for i in range(60)]
    ref = [pick.choice([None, 0, 2, 4, 9]) for _ in range(30)]
    mapping = {0: "zero", 3: "three", 9: "nine"}
    df = spark.createDataFrame(data, "k int, n int, v string").repartition(3)
    ref_df = spark.createDataFrame([(r,) for r in ref], "r int").repartition(3)
    known = {r for r in ref if r is not None}

    flagged = exists_flag(df, ref_df, "k", "r", flag="f", hot_rows=hot_rows)
    assert rows(flagged) == sorted([(*d, d[0] in known) for d in data], key=repr)
    kept = keep_matching(df, ref_df, "k", "r", hot_rows=hot_rows)
    assert rows(kept) == sorted([d for d in data if d[0] in known], key=repr)
    table = spark.createDataFrame(list(mapping.items()), "m int, value string")
    for only_blank in (False, True):
        got = lookup_override(
            df, table, "k", "v", "value", "m", only_blank=only_blank, hot_rows=hot_rows
        )
        expected = [
            (k, n, mapping.get(k, v) if not (only_blank and v == "v") else v) for k, n, v in data
        ]
        assert rows(got) == sorted(expected, key=repr)


def test_composite_key(spark):
    left = spark.createDataFrame([(1, "A"), (1, "B"), (None, "A")], "id int, wave string")
    right = spark.createDataFrame([(1, "A", "p"), (1, "A, B", "q")], "key int, Wave2 string, p string")
    got = left_join(left, right, ["id", "wave"], ["key", "Wave2"], hot_rows=1)
    assert rows(got, "id", "wave", "p") == [(1, "A", "p"), (1, "B", None), (None, "A", None)]
