"""Counts and differences over several days, sides laid out by id, rows left out early."""

import random

import campaign
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from rosterlane.operators import (
    bitmap_counts,
    metric_bitmaps,
    number_keys,
    prefilter,
    prefiltered,
    table_changes,
)
from rosterlane.plans import (
    build_base,
    build_detail,
    build_trend,
    daily_changes,
    form_choice,
    lay_out_sides,
    publish_trend,
    trend_over_days,
)
from rosterlane.plans.report import run_report

DATE = "01/02/2025"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pages")
    campaign.land_pages(path)
    return campaign.inputs(spark, path)


def test_numbers_go_on_and_never_change(spark):
    first = spark.range(1000).selectExpr("cast(id % 700 as string) as k").union(spark.sql("select null"))
    one = number_keys(first.repartition(7), "k").checkpoint()
    assert one.count() == 700 and rows(one.agg(F.min("number"), F.max("number"), F.count_distinct("number"))) == [(1, 700, 700)]
    second = spark.range(600, 800).selectExpr("cast(id as string) as k")
    two = number_keys(second, "k", one)
    assert rows(two.agg(F.min("number"), F.max("number"), F.count("*"))) == [(701, 800, 100)]
    assert two.join(one, "k").count() == 0
    assert number_keys(first.where("false"), "k", one).count() == 0


def test_merged_counts_equal_counting_all_rows(spark):
    df = spark.range(200_000).selectExpr("id % 70000 as k", "id % 5 as day", "id % 7 = 0 as seventh", "if(id % 3 = 0, null, true) as known")
    metrics = {"all": None, "seventh": "seventh", "known": F.col("known"), "never": "false"}
    numbers = number_keys(df, "k").checkpoint()
    days = [metric_bitmaps(df.where(f"day = {d}"), "k", numbers, metrics) for d in (0, 3)]
    both = df.where("day in (0, 3)")
    want = both.agg(
        F.count_distinct("k"), F.count_distinct(F.when(F.col("seventh"), F.col("k"))),
        F.count_distinct(F.when(F.col("known"), F.col("k"))), F.lit(0),
    )
    merged = bitmap_counts(days[0].union(days[1]), metrics)
    assert merged.columns == list(metrics) and rows(merged) == rows(want)
    assert rows(bitmap_counts(days[0].where("false"), metrics)) == [(0, 0, 0, 0)]


def test_trend_over_days_reads_bitmaps_only(spark, inputs, tmp_path):
    base, forms = build_base(inputs).checkpoint(), form_choice(inputs.form).checkpoint()
    store = str(tmp_path / "trend")
    some = base.where("PROVIDER_TAX_ID in ('111111111', '222222222')")
    for day, rows_of_day in (("d1", some), ("d2", base), ("d1", some.where("WAVE = 'PCS'")), ("d3", some.where("false"))):
        publish_trend(spark, store, day, rows_of_day, forms)
    whole = trend_over_days(spark, store)
    assert rows(whole) == rows(build_trend(base, forms, DATE).drop("EVENT_DATE"))
    one = trend_over_days(spark, store, ["d1", "d3"])
    assert rows(one) == rows(build_trend(some.where("WAVE = 'PCS'"), forms, DATE).drop("EVENT_DATE"))
    scans = [line for line in plan(whole).split("\n") if "FileScan" in line]
    assert scans and all("ReadSchema: struct<metric:string,bucket:bigint,bits:binary>" in line for line in scans)


def test_changes_equal_comparing_row_by_row(spark):
    pick = random.Random(5)
    columns = ["a", "b", "c", "d"]

    def state():
        keys = pick.sample([(i, w) for i in [None, *range(30)] for w in ("x", None)], 40)
        return {k: (pick.choice([None, 1, 2]), pick.choice([None, "s"]), pick.choice([1.0, None]), pick.choice([None, 5])) for k in keys}

    old, new = state(), state()
    for key in list(old)[:15]:
        new[key] = old[key]
    schema = "id int, w string, a int, b string, c double"
    before = spark.createDataFrame([(*k, *v[:3]) for k, v in old.items()], schema)
    after = spark.createDataFrame([(*k, v[2], v[0], v[3], v[1]) for k, v in new.items()], "id int, w string, c double, a int, d int, b string")
    want = []
    for key in {*old, *new}:
        if key not in old:
            want.append((*key, "added", None))
        elif key not in new:
            want.append((*key, "removed", None))
        else:
            one, other = (*old[key][:3], None), new[key]
            names = [n for n in ("c", "a", "d", "b") if one[columns.index(n)] != other[columns.index(n)]]
            if names:
                want.append((*key, "changed", names))
    found = table_changes(before, after, ["id", "w"])
    assert found.columns == ["id", "w", "change", "columns"]
    assert rows(found) == sorted(want, key=repr)
    assert table_changes(before, before, ["id", "w"]).count() == 0
    assert table_changes(before.where("false"), before, ["id", "w"]).where("change = 'added'").count() == 40


def test_unchanged_rows_are_compared_by_their_hashes(spark, tmp_path):
    spark.range(100).selectExpr("id", "uuid() as wide", "map('a', id) as m").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    other = table.withColumn("m", F.when(F.col("id") == 7, F.create_map(F.lit("a"), F.lit(0).cast("long"))).otherwise(F.col("m")))
    assert rows(table_changes(table, other, ["id"])) == [(7, "changed", ["m"])]


def test_changes_between_published_days(spark, inputs, tmp_path):
    import datetime
    from dataclasses import replace

    store, export = str(tmp_path / "store"), str(tmp_path / "export")
    moment = datetime.datetime(2025, 1, 3, 3, tzinfo=datetime.timezone.utc)
    run_report(inputs, moment, store, export, "R")
    changed = replace(inputs, payers=inputs.payers.where("false"))
    run_report(changed, moment + datetime.timedelta(days=1), store, export, "R")
    found = daily_changes(spark, store, "2025-01-02", "2025-01-03")
    with_payers = {(w, i) for (w, i), v in campaign.DETAIL.items() if v[6] != "nan"}
    assert {(r["WAVE"], r["PROVIDER_TAX_ID"]) for r in found.collect()} == with_payers
    assert {(r["change"], tuple(r["columns"])) for r in found.collect()} == {("changed", ("PAYERS",))}


def test_laid_out_sides_are_not_shuffled(spark, inputs, tmp_path):
    forms = form_choice(inputs.form)
    want = rows(build_detail(build_base(inputs), forms, DATE))
    laid = lay_out_sides(inputs, "test_sides", 4, str(tmp_path))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = build_detail(build_base(laid), forms, DATE)
        assert rows(df) == want
        lines = plan(df).split("Initial Plan")[0].split("\n")
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        scans = [i for i, line in enumerate(lines) if "FileScan parquet spark_catalog.default.test_sides_" in line]
        assert len(scans) == 3
        for i in scans:
            assert "Bucketed: true" in lines[i]
            # From the scan up to the join there is no exchange.
            at = depth(lines[i])
            for line in reversed(lines[:i]):
                if depth(line) < at:
                    at = depth(line)
                    assert "Exchange" not in line
                    if "Join" in line:
                        break
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("enrolments", "payers", "portal_dim"):
            spark.sql(f"drop table if exists test_sides_{name}")


@pytest.mark.parametrize("share", [0.0, 0.01, 0.3])
def test_rows_before_the_shuffle_fall_with_the_share_of_wanted_ids(spark, share):
    df = spark.range(20_000).selectExpr("if(id % 50 = 0, null, id % 5000) as k", "id")
    wanted = spark.range(int(5000 * share)).selectExpr("id as w").union(spark.sql("select null"))
    kept = prefiltered(df, wanted, ["k"], ["w"])
    assert kept.columns == df.columns and "Exchange hashpartitioning(k#" not in plan(kept)
    exact = df.join(wanted, F.col("k") == F.col("w"), "semi")
    assert exact.exceptAll(kept).count() == 0
    known = df.where("k is not null").count()
    assert exact.count() <= kept.count() <= exact.count() + 0.01 * known


def test_prefilter_of_several_keys_and_beyond_its_size(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "a", 2), (None, "a", 3)], "k int, w string, n int")
    wanted = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "k int, w string")
    assert (0,) in rows(prefiltered(df, wanted, ["k", "w"]), "n")
    assert prefiltered(df, wanted, ["k", "w"]).where("k is null").count() == 0
    monkeypatch.setattr(prefilter, "MOST_WORDS", 0)
    assert rows(prefiltered(df, wanted, ["k", "w"]), "n") == [(0,), (1,), (2,)]
