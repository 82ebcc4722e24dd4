import corpus_pipeline
import pytest
from helpers_llm import FOLDER
from rosterlane.llm.common import kept_table


@pytest.fixture(scope="module")
def stages(spark, documents):
    tables, docs = [documents], documents
    for name, stage in corpus_pipeline.STAGES:
        docs = kept_table(stage(spark, docs, str(FOLDER)), "test-stage")
        tables.append(docs)
    return tables


def test_stages_keep_the_columns(stages):
    for table in stages[:-1]:
        assert table.columns == stages[0].columns
    assert stages[-1].columns == ["doc_id", "lang", "source", "n_pieces", "ids", "decodes"]


def test_decisions_take_effect(spark, stages):
    raw, good, single, masked, mixed, coded = ({r["doc_id"]: r for r in t.collect()} for t in stages)
    bad = {r["doc_id"] for r in spark.read.parquet(str(FOLDER / "labels.parquet")).collect() if r["quality"] == 0}
    assert len(good) < len(raw) and len(bad & good.keys()) <= 0.1 * len(bad)
    assert len(single) < len(good) and len({r["text"] for r in single.values()}) == len(single)
    assert masked.keys() == single.keys()
    for r in masked.values():
        assert r["n_chars"] == len(r["text"])
        assert r["text"] == single[r["doc_id"]]["text"] or "[secret]" in r["text"]
    assert mixed.keys() == masked.keys() == coded.keys()
    assert stages[4].count() == stages[5].count() > stages[3].count()
    assert all(r["decodes"] and r["n_pieces"] == len(r["ids"]) for r in coded.values())


def test_run_equals_the_stages(spark, stages):
    rows = corpus_pipeline.run(spark, str(FOLDER)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, stages[-1].collect()))


def test_odd_rows_go_through(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept_table(stage(spark, docs, str(FOLDER)), "test-odd")
        assert docs.columns == odd.columns
    assert corpus_pipeline.encoding(spark, docs, str(FOLDER)).count() == docs.count()
    nothing = odd.where("doc_id > 100")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, str(FOLDER)).count() == 0
