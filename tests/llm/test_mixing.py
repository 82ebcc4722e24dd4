import math

import pytest
from helpers_llm import words
from pyspark.sql import functions as F
from rosterlane.llm import mixing

SHARES = {"a": 0.6, "b": 0.3, "c": 0.1}


def entropy(shares):
    return -math.fsum(p * math.log2(p) for p in shares.values() if p > 0)


def most_repeats(shares, exponent, budget):
    mixed = mixing.weights(shares, exponent)
    passes = [mixed[k] / s for k, s in shares.items() if s > 0]
    return max(passes) * (budget if budget is not None else 1 / min(passes))


def test_exponent_meets_entropy():
    exponent = mixing.solve_exponent(SHARES, target_entropy=1.5)
    assert math.isclose(entropy(mixing.weights(SHARES, exponent)), 1.5, abs_tol=1e-9)
    exponent = mixing.solve_exponent(SHARES, evenness=0.25)
    assert math.isclose(entropy(mixing.weights(SHARES, exponent)), 0.75 * entropy(SHARES) + 0.25 * math.log2(3), abs_tol=1e-9)
    assert mixing.solve_exponent(SHARES, target_entropy=9) == 0.0
    assert math.isclose(mixing.solve_exponent(SHARES, target_entropy=0.1), 1.0)


def test_exponent_meets_repetition():
    for budget in (1.0, 0.5, None):
        exponent = mixing.solve_exponent(SHARES, max_repeats=1.5, budget=budget)
        if exponent > 0:
            assert math.isclose(most_repeats(SHARES, exponent, budget), 1.5, rel_tol=1e-9)
    assert mixing.solve_exponent(SHARES) == 1.0
    assert mixing.solve_exponent({}, max_repeats=2.0) == 0.0


@pytest.fixture(scope="module")
def docs(documents):
    hot = F.expr("case when doc_id % 3 = 0 then 'hot' when source = 'src5' then null else source end")
    return documents.withColumn("source", hot)


def test_stream_has_the_weights(docs):
    tokens = {}
    for r in docs.collect():
        tokens[r["source"]] = tokens.get(r["source"], 0) + len(words(r["text"]))
    total = sum(tokens.values())
    shares = {k: v / total for k, v in tokens.items()}
    rows = mixing.mixture(docs, max_repeats=2.0, block_tokens=500).collect()
    exponent = mixing.solve_exponent(shares, max_repeats=2.0)
    wanted = mixing.weights(shares, exponent)
    longest = max(len(words(r["text"])) for r in docs.collect())
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    for source, found in by.items():
        read = sum(r["tokens"] for r in found)
        assert 0 <= read - wanted[source] * total < longest + 1
        per_doc = {}
        for r in found:
            per_doc.setdefault(r["doc_id"], []).append(r["epoch"])
        # Passes start anew only when the one before is over; nobody is read twice in one.
        passes = wanted[source] / shares[source]
        for epochs in per_doc.values():
            assert sorted(epochs) == list(range(len(epochs))) or passes < 1 and epochs == [0]
            assert math.floor(passes + 1e-9) <= len(epochs) <= math.ceil(passes)
        places = sorted((r["position"], r["epoch"]) for r in found)
        assert [e for _, e in places] == sorted(e for _, e in places)
        assert 0 <= places[0][0] and places[-1][0] < 1


def test_blocks_are_permuted_anew(docs):
    rows = mixing.mixture(docs, max_repeats=3.0, block_tokens=300).where("source = 'src1'").collect()
    orders = {}
    for r in sorted(rows, key=lambda r: r["position"]):
        blocks = orders.setdefault(r["epoch"], [])
        if r["block"] not in blocks:
            blocks.append(r["block"])
    assert len(orders) >= 2 and orders[0] != orders[1]
    for epoch in orders:
        places = [r["block"] for r in sorted((r for r in rows if r["epoch"] == epoch), key=lambda r: r["position"])]
        assert len([1 for a, b in zip(places, places[1:]) if a != b]) == len(orders[epoch]) - 1


def test_no_source_is_cut(docs):
    rows = mixing.mixture(docs, max_repeats=1.5, budget=None).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}
    mixed = mixing.mixed_documents(docs, max_repeats=1.5, budget=None)
    assert mixed.columns == docs.columns and mixed.count() == len(rows)


def test_same_stream_every_time(docs):
    first = mixing.mixture(docs, target_entropy=4.0).collect()
    again = mixing.mixture(docs.repartition(3), target_entropy=4.0).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_odd_rows(odd):
    rows = mixing.mixture(odd).collect()
    assert len(rows) == odd.count()
    assert {r["epoch"] for r in rows} == {0}
    mixed = mixing.mixed_documents(odd, max_repeats=2.0, budget=None)
    assert mixed.columns == odd.columns
    assert {r["doc_id"] for r in mixed.collect()} == {r["doc_id"] for r in odd.collect()}
    assert mixing.mixture(odd.where("doc_id > 100"), max_repeats=2.0).count() == 0


def test_table_gives_the_same_exponent(spark):
    totals = spark.createDataFrame([("a", 600), ("b", 300), (None, 100), ("d", 0)], "name string, total long")
    table = mixing.Shares.of_table(totals)
    for options in ({"target_entropy": 1.4}, {"max_repeats": 1.2}, {"evenness": 0.5}, {"max_repeats": 1.1, "budget": None}):
        assert math.isclose(mixing.solve_exponent(table, **options), mixing.solve_exponent(SHARES, **options), abs_tol=1e-9)
    assert mixing.Shares.of_table(totals.where("total = 0")) is None


def test_limit_binds_on_all_tables(spark):
    """In the query and in the pipeline there is a temperature between the extremes."""
    import corpus_pipeline
    from helpers_llm import FOLDER
    from rosterlane.llm import queries

    for name in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(str(FOLDER.parent / name / "documents.parquet"))
        read = mixing.mixture(docs, evenness=queries.EVENNESS, max_repeats=queries.MAX_REPEATS)
        assert 0.01 < read.first()["exponent"] < 0.99
        read = mixing.mixture(docs, **corpus_pipeline.MIXING)
        assert 0.01 < read.first()["exponent"] < 0.99


def test_as_many_sources_as_documents(docs):
    many = docs.withColumn("source", F.col("doc_id").cast("string"))
    rows = mixing.mixture(many, evenness=0.5, budget=None).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in docs.collect()}


def test_a_hot_id_is_dealt_over_the_blocks(docs):
    """A third of the rows has one id, others none; copies of one row are dealt as well."""
    hot = docs.withColumn("source", F.lit("s")).withColumn(
        "doc_id", F.expr("case when doc_id % 3 = 0 then 7 when doc_id % 3 = 1 then null else doc_id end")
    )
    sizes = [r["count"] for r in mixing.mixture(hot, block_rows=10).groupBy("block").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 30
    copies = hot.sparkSession.range(300).selectExpr("1L as doc_id", "'one two' as text", "'s' as source")
    sizes = [r["count"] for r in mixing.mixture(copies, block_rows=10).groupBy("block").count().collect()]
    assert sum(sizes) == 300 and max(sizes) <= 30


def test_long_passes_are_added_up_in_runs(docs, monkeypatch):
    whole = mixing.mixture(docs, evenness=0.5, max_repeats=3.0, block_rows=2).collect()
    monkeypatch.setattr(mixing, "RUN_BLOCKS", 3)
    runs = mixing.mixture(docs, evenness=0.5, max_repeats=3.0, block_rows=2).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, runs))
