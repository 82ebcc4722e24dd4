import math

import numpy as np
import pytest
from helpers_llm import FOLDER, ordered
from pyspark.sql import functions as F
from rosterlane.llm import topk


def brute(rows, every, k, scale=256):
    good = [
        (i, np.array([math.floor(scale * float(x)) for x in v], object))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    queries = sorted({(i, tuple(v)) for i, v in good if i % every == 0})
    out = []
    for q, query in queries:
        found = [(-int(sum(a * b for a, b in zip(query, v))), i) for i, v in good if i != q and len(v) == len(query)]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return ordered(out)


def got(df, every, k, **options):
    return ordered(topk.exact_top_k(df, F.col("vec_id") % every == 0, k, **options).collect())


def rows_of(df):
    return [(r["vec_id"], r["embedding"]) for r in df.collect()]


@pytest.mark.parametrize("bits", [2, 4, 8])
def test_equals_brute_force(spark, bits):
    vectors = spark.read.parquet(str(FOLDER / "embeddings.parquet")).where("vec_id < 160")
    assert got(vectors, 25, 5, bits=bits) == brute(rows_of(vectors), 25, 5)


def test_small_blocks(spark):
    vectors = spark.read.parquet(str(FOLDER / "embeddings.parquet")).where("vec_id < 120")
    assert got(vectors, 10, 4, vector_block=10, query_block=3) == brute(rows_of(vectors), 10, 4)


@pytest.mark.parametrize("power", [56, 61, 200])
def test_scores_beyond_double_precision(spark, power):
    """Whole components whose scores need more digits than a double has; beyond a long it raises."""
    rng = np.random.default_rng(int(power))
    size = 2 ** ((power - 6) / 2)
    rows = [(i, [float(int(x)) / 256 for x in rng.uniform(0.1 * size, size, 64)]) for i in range(120)]
    # Ties but for the last digit.
    rows += [(200 + i, rows[7][1][:-1] + [rows[7][1][-1] + (i % 3) / 256]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if power > 63:
        with pytest.raises(Exception, match="does not fit a long"):
            got(df, 10, 5)
        return
    want = brute(rows, 10, 5)
    assert max(r[3] for r in want) > 2**53
    assert got(df, 10, 5) == want


def test_a_third_of_the_rows_has_one_id(spark):
    rng = np.random.default_rng(3)
    rows = [(50 if i % 3 == 0 else i, rng.integers(-99, 99, 8).astype(float).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    vectors = topk.whole_vectors(df, "vec_id", "embedding", 256).withColumn("row", F.monotonically_increasing_id())
    sizes = [len(r["ids"]) for r in topk.approximations(vectors, 64, 4).collect()]
    assert max(sizes) <= 64 and sum(sizes) == 900 and len(sizes) <= 18
    few = df.where("vec_id <> 50 or rand(1) < 0.05")
    rows = [tuple(r) for r in few.collect()]
    found = topk.exact_top_k(spark.createDataFrame(rows, few.schema), F.col("vec_id") % 50 == 0, 3, vector_block=64)
    # Every vector of a repeated id has its own ranks.
    assert ordered(found.collect()) == brute(rows, 50, 3)


def test_copies_are_not_paired(spark, monkeypatch):
    """Of 600 equal vectors only those that can be among the results are scanned."""
    rows = [(i, [1.0, 2.0]) for i in range(600)] + [(700 + i, [float(i), 0.5]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, 100, 5) == brute(rows, 100, 5)
    assert topk.first_of_equal(topk.whole_vectors(df, "vec_id", "embedding", 256), 5).count() == 10 + 9


def test_few_exact_vectors_are_read(spark, monkeypatch):
    vectors = spark.read.parquet(str(FOLDER / "embeddings.parquet"))
    read = []
    monkeypatch.setattr(topk, "scored", lambda met, f=topk.scored: read.append(met.count()) or f(met))
    found = got(vectors, 50, 5)
    asked = len({r[0] for r in found})
    assert sum(read) < 0.1 * asked * vectors.count()


def test_ties_nulls_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25]) for i in range(0, 60)]
    rows += [(100, [0.1, 0.2]), (101, None), (102, [nan, 0.0]), (103, [inf, 0.0]), (105, [None, 1.0])]
    rows += [(110, []), (120, [1.0, 2.0, 3.0]), (130, [1.0, 0.0, 3.0]), (None, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1))
    want = brute(rows, 10, 5)
    assert got(df, 10, 5) == want
    assert {r for r in want if r[0] == 120} == {(120, 1, 130, 655360)}
    assert got(df.where("vec_id > 1000"), 10, 5) == []


@pytest.mark.parametrize("scale", [1, 1e6, 1e30])
def test_bounds_hold(scale):
    rng = np.random.default_rng(0)
    vectors = rng.integers(-300, 300, (200, 16)) * scale
    queries = rng.integers(-300, 300, (9, 16)) * scale
    for bits in (3, 8):
        below, above = topk.bounds(queries, *topk.quantised(vectors, bits))
        exact = queries @ vectors.T
        assert (below <= exact).all() and (exact <= above).all()


@pytest.mark.parametrize("bits", range(1, 9))
def test_cells_take_few_bits(bits):
    cells = np.random.default_rng(bits).integers(0, 1 << bits, (7, 5)).astype(np.uint8)
    data = topk.packed_bits(cells, bits)
    assert len(data) == -(-35 * bits // 8)
    assert (topk.unpacked_bits(data, 7, 5, bits) == cells).all()
