import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rosterlane.llm import pieces, token_counts, unigram
from tokenizers import Tokenizer
from tokenizers.models import Unigram

VOCABULARY = unigram.read_vocabulary(unigram.default_model())


@pytest.fixture(scope="module")
def library():
    """The same vocabulary in another implementation; ids that match nothing get a text of their own."""
    rows = zip(VOCABULARY.texts, VOCABULARY.scores, VOCABULARY.kinds)
    entries = [(t, s) if k == unigram.NORMAL else (f"\x01{i}\x01", -1e9) for i, (t, s, k) in enumerate(rows)]
    return Tokenizer(Unigram(entries, unk_id=0, byte_fallback=False))


def marked_words(text):
    return [unigram.MARK + key for key in unigram.word_keys(text)]


def distinct_words(texts):
    return sorted({word for text in texts for word in marked_words(text)})


def test_words_equal_the_library(documents, library):
    texts = [r["text"] for r in documents.select("text").collect()]
    found = distinct_words(texts)
    for word, ids in zip(found, pieces.shared_prefix_viterbi(found, VOCABULARY)):
        if all(c in VOCABULARY.pieces for c in word):
            assert ids == library.encode(word, add_special_tokens=False).ids


def plain_viterbi(word):
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - 16), end):
            found = VOCABULARY.pieces.get(word[start:end])
            if found is None and end - start == 1:
                found = (-1, VOCABULARY.unknown)
            if found is None:
                continue
            score = best[start][0] + found[1]
            if best[end] is None or score > best[end][0]:
                ids = [found[0]] if found[0] >= 0 else [VOCABULARY.byte_ids[b] for b in word[start:end].encode()]
                best[end] = (score, best[start][1] + ids)
    return best[-1][1]


TEXTS = st.text(alphabet="the aeinrs ▁\n\tö🙂日\x00", max_size=30)


@settings(max_examples=100, deadline=None)
@given(st.lists(TEXTS | st.none(), max_size=6))
def test_texts_equal_plain_viterbi(texts):
    batch = pa.array(texts, pa.string())
    got = pieces.encode_batch(batch, VOCABULARY).to_pylist()
    for text, ids in zip(texts, got, strict=True):
        parts = marked_words(text)
        assert "".join(parts) == (unigram.MARK + text.replace(" ", unigram.MARK) if text else "")
        assert ids == [i for part in parts for i in plain_viterbi(part)]
        decoded = pieces.decoded_bytes(np.array(ids, np.int64), VOCABULARY.piece_bytes).decode()
        assert decoded == (text or "").replace("▁", " ")
    counts = token_counts.counts_of(batch, VOCABULARY, {})
    assert counts.tolist() == [len(ids) for ids in got]


def test_counts_over_several_layouts(monkeypatch):
    monkeypatch.setattr(token_counts, "BLOB", 10)
    texts = pa.array(["the sea\nand ö🙂", "a " * 40, ""])
    ids = pieces.encode_batch(texts, VOCABULARY).to_pylist()
    assert token_counts.counts_of(texts, VOCABULARY, {}).tolist() == [len(x) for x in ids]


def test_runs_of_texts():
    texts = pa.array(["a" * 5, None, "b" * 30, "", "c", "d" * 9])
    found = [run.to_pylist() for run in unigram.groups(texts, 10)]
    assert [text for run in found for text in run] == texts.to_pylist()
    assert len(found) > 1
    assert [run.to_pylist() for run in unigram.groups(texts.slice(0, 0), 10)] == [[]]


def test_columns(documents, odd):
    for df in (documents, odd):
        both = token_counts.with_token_counts(pieces.coded(pieces.decoded(pieces.encoded(df)), ids="ids2"))
        rows = both.collect()
        assert len(rows) == df.count() and set(df.columns) <= set(both.columns)
        for r in rows:
            assert r["decoded"] == (r["text"] or "").replace("▁", " ")
            assert r["ids"] == r["ids2"] and len(r["ids"]) == r["n_tokens"] and r["round_trip"]
    assert pieces.coded(odd.where("doc_id > 100")).count() == 0
    broken = documents.limit(1).selectExpr("array(3 + 195, 3 + 40) as ids")
    assert pieces.decoded(broken).first()["decoded"] == "\ufffd("
