import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers_llm import FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st
from rosterlane.llm import packing, queries
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def plain_pieces(tokenizer, rows, capacity=4096, end=1):
    """(key, piece, start, length, crc) of every piece, by the library alone."""
    out = []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]
        for at in range(0, len(ids), capacity):
            part = ids[at : at + capacity]
            out.append((key, at // capacity, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return sorted(out, key=repr)


def check_layout(rows, capacity):
    """Pieces lie in their sequences without gaps; returns the number of sequences."""
    held = {}
    for r in rows:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spots in held.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(held) == list(range(len(held)))
    return len(held)


def test_query_on_all_documents(spark, documents, tokenizer):
    rows = queries.QUERIES["op13_packing"](spark, str(FOLDER)).collect()
    plain = plain_pieces(tokenizer, documents.select("doc_id", "text").collect())
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == plain
    used = check_layout(rows, 4096)
    assert used <= 1.01 * -(-sum(r["length"] for r in rows) // 4096) + 1


@pytest.mark.parametrize("capacity", [1, 7, 64])
def test_odd_rows(spark, odd, tokenizer, capacity):
    rows = packing.packed(odd, capacity).collect()
    plain = plain_pieces(tokenizer, odd.select("doc_id", "text").collect(), capacity)
    short = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(short, key=repr) == plain
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    check_layout(rows, capacity)
    assert packing.packed(odd.where("doc_id > 100")).collect() == []


def test_clashing_names_and_text_keys(spark):
    docs = spark.createDataFrame([("a", "x y", 1, 2)], "id string, body string, piece int, length int")
    (row,) = packing.packed(docs, key="id", text="body").collect()
    assert (row["id"], row["piece"], row["length"]) == ("a", 0, 3)


def test_words_of_a_slice(tokenizer, monkeypatch):
    """Slices, forgetting, signs after words, special tokens and every kind of white space."""
    spaces = [chr(c) for c in (*range(1, 33), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    text = " ".join(["it's THE end..., <|endoftext|>. é ΑΣ, 3.5. x.̸ İ. don't!? É. a;b \x1ca\x1fb.", *(f"a{s}b.{s}" for s in spaces)])
    for size in (1, 5, 10_000):
        monkeypatch.setattr(packing, "SLICE", size)
        monkeypatch.setattr(packing, "REMEMBERED", size)
        words = packing.WordIds(public_tokenizers.path(packing.TOKENIZER))
        ids = np.frombuffer(b"".join(words.of_text(text)), "<u4")
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=60), st.integers(1, 12))
def test_patterns_hold_every_piece(lengths, groups):
    counts = np.bincount(lengths, minlength=41)
    patterns = packing.packing(counts, 40, groups)
    held = np.zeros(41, int)
    for p in patterns:
        assert sum(length * n for length, n in p.runs) <= 40
        for length, n in p.runs:
            held[length] += n * p.count
    assert (held == counts).all()
    # Never worse than longest first, each to the first sequence that has room.
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = next((i for i, room in enumerate(rooms) if room >= length), None)
        if fit is None:
            rooms.append(40 - length)
        else:
            rooms[fit] -= length
    assert sum(p.count for p in patterns) <= len(rooms) + 1


def test_configurations_beat_longest_first():
    """Pieces of 6 sizes whose best packing is known: each triple fills a sequence."""
    counts = np.zeros(101, np.int64)
    for length in (50, 30, 20, 45, 35):
        counts[length] = 1000
    counts[20] += 1000
    assert sum(p.count for p in packing.packing(counts, 100)) == 2000


def test_groups_have_equal_cardinality():
    counts = np.bincount([9] * 9 + [8] * 3 + [5] * 8)
    assert packing.linear_groups(counts, 2) == [[(9, 9), (8, 1)], [(8, 2), (5, 8)]]
    assert packing.linear_groups(counts, 3) == [[(9, 9)], [(8, 3)], [(5, 8)]]


def test_signs_after_a_word_are_no_new_word(tokenizer):
    """What is learned are words and runs of signs, not every pair of them; added tokens stay whole."""
    words = packing.WordIds(public_tokenizers.path(packing.TOKENIZER))
    learned = []
    learn = words.learn
    words.learn = lambda new: (learned.extend(new), learn(new))
    text = "Word&&& \u00c9t\u00e9, word*** \u00e9t\u00e9### word's' Word&&& a<|endoftext|> b<|endoftext|>, c|> d<"
    ids = b"".join(words.of_text(text))
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert {"Word", "&&&", "\u00c9t\u00e9", "***", "a<|endoftext|>"} <= set(learned)
    assert not {"Word&&&", "\u00c9t\u00e9,", "word***", "\u00e9t\u00e9###"} & set(learned)
    assert len(learned) == len(set(learned))
