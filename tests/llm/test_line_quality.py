import zlib
from itertools import product

import numpy as np
import pyarrow as pa
from rosterlane.llm import line_quality as q
from rosterlane.llm.queries import QUERIES
from helpers_llm import FOLDER


def lines_of(texts):
    from rosterlane.llm.words import text_bytes

    found = [q.own_features(data) for data in text_bytes(pa.array(texts, pa.string()))]
    return q.gathered([f for f, _ in found], [n for _, n in found])


def test_marginals_equal_enumeration():
    texts = ["A b\nC!! D!!\nx x x\n\nq", "one", "", "u v\nw"]
    lines = lines_of(texts)
    rng = np.random.default_rng(1)
    field = q.Field(rng.normal(size=q.N_FEATURES), rng.normal(size=(2, 2)))
    emissions = field.emissions(lines)
    got = q.document_quality(field, lines)
    for i, (a, b) in enumerate(zip(lines.bounds[:-1], lines.bounds[1:])):
        e, n = emissions[a:b], b - a
        total, good = 0.0, np.zeros(n)
        for labels in product((0, 1), repeat=n):
            score = sum(e[t] * labels[t] for t in range(n))
            score += sum(field.pairs[x, y] for x, y in zip(labels, labels[1:]))
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        want = np.average(good / total, weights=lines.lengths[a:b])
        assert abs(want - got[i]) < 1e-9


def test_features_of_lines():
    own, lengths = q.own_features(np.frombuffer(b"AB cd\nAB cd\nx x 1|!", np.uint8))
    column = dict(zip(q.OWN, own.T.tolist()))
    assert lengths.tolist() == [6, 6, 8]
    assert column["capitals"][:2] == [0.5, 0.5]
    assert column["seen_line"] == [0, 1, 0]
    assert column["same_as_last_word"][2] == 1 / 3
    assert column["pipes"][2] == 1 / 3


def test_held_out_accuracy(spark):
    folder = str(FOLDER.parent / "sf0.01")
    scored = QUERIES["op2_line_quality"](spark, folder)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    for quality in (0, 1):
        of_label = [r for r in held if labels[r["doc_id"]] == quality]
        assert sum(r["predicted"] == quality for r in of_label) >= 0.95 * len(of_label)


def test_odd_rows_and_no_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = q.scored(odd, labels).collect()
    assert len(rows) == odd.count() and {r["score"] for r in rows} == {0.5}
    labels = spark.createDataFrame(
        [(4, 1), (4, 1), (6, 0), (5, None), (None, 0), (7, 1), (2, 0), (3, 0)], "doc_id long, quality int"
    )
    scores = [r["score"] for r in q.scored(odd, labels, "quality").withColumnRenamed("quality", "score2").selectExpr("score2 as score").collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert q.scored(odd.where("doc_id > 100"), labels, "quality").count() == 0


def test_sample_of_repeated_ids_is_bounded(spark):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(ids[0], f"text {i % 50}") for i in range(500)] + [(ids[1], "same")] * 300 + [(i, "one") for i in ids[2:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    found = [r["doc_id"] for r in q.training_rows(docs, labels, 100, 300).collect()]
    assert {i: found.count(i) for i in ids} == {i: 1 for i in ids} | {ids[0]: q.TRAIN_TEXTS}


def test_long_chains():
    text = "good line here.\n" * 3000
    lines = lines_of([text, "x"])
    assert np.isfinite(q.document_quality(q.Field(np.ones(q.N_FEATURES), np.eye(2)), lines)).all()
