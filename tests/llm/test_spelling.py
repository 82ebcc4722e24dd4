import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import ordered
from rosterlane.llm import spelling

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_words(rows, least=5, count=3, loss=97):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % loss == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= count}


def plain_groups(words):
    """Near words by the strings that are left without a letter or have a gap for it."""
    patterns, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            patterns[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in patterns.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 2 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return ordered(
        (w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()
    )


@pytest.fixture(scope="module")
def variants(spark):
    """Chains and stars of near words, letters beyond ASCII, very long runs, clashing columns."""
    rng = np.random.default_rng(7)
    alphabet = "abcàéþÿ×÷"
    words = ["".join(rng.choice(list(alphabet), rng.integers(4, 9))) for _ in range(60)]
    for i in range(120):
        base = words[rng.integers(len(words))]
        at, letter = rng.integers(len(base)), alphabet[rng.integers(len(alphabet))]
        words.append([base[:at] + base[at + 1 :], base[:at] + letter + base[at:], base[:at] + letter + base[at + 1 :]][i % 3])
    # A chain of which every link is twice as frequent as the one before.
    chain = ["chain" + "x" * i for i in range(7)]
    long_words = ["z" * 3000, "z" * 3001, "z" * 1400 + "y" + "z" * 1599, "aé" * 100, "aé" * 99 + "a"]
    rows = [(i, " ".join(rng.choice(words, 60)) + ", " + words[i].upper()) for i in range(100)]
    rows += [(1000 + i, " ".join([w] * (3 * 2**i))) for i, w in enumerate(chain)]
    rows += [(2000, "\n".join(w for w in long_words for _ in range(3)))] * 2
    rows += [(None, None), (3000, None), (3001, ""), (None, "nokey nokez nokey nokez nokey nokez Ωωnokey"), (4000, "a b c")]
    return spark.createDataFrame([(*r, "x", 1, b"w") for r in rows], "doc_id long, text string, word string, n int, w binary")


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 512])
def test_groups_equal_brute_force(spark, variants, filter_bytes):
    rows = variants.select("doc_id", "text").collect()
    words = plain_words([tuple(r) for r in rows])
    assert any(len(w) == 3001 for w in words) and len(words) > 100
    assert ordered(spelling.variant_groups(variants, filter_bytes=filter_bytes).collect()) == plain_groups(words)


def test_one_bound_for_every_round():
    sizes = {5: 10_000, 6: 300_000, 7: 1, 64: 20, 1 << 20: 3}
    for limit in (64, 4096, 1 << 20, 1 << 30):
        rounds = spelling.rounds(sizes, limit)
        for shards in rounds:
            assert sum(s.blocks for s in shards) * 64 <= limit
            assert all(a.start + a.blocks == b.start for a, b in zip(shards, shards[1:]))
        for name in sizes:
            parts = [s for shards in rounds for s in shards if s.name == name]
            assert sorted(s.part for s in parts) == list(range(parts[0].parts))
            assert {s.parts for s in parts} == {len(parts)}
    assert len(spelling.rounds(sizes, 1 << 30)) == 1 and len(spelling.rounds(sizes, 4096)) > 100


def test_filter_lets_few_pass_and_all_that_it_holds():
    rng = np.random.default_rng(1)
    inside = rng.integers(0, (1 << 64) - 1, 20_000, np.uint64)
    (shard,) = spelling.rounds({8: len(inside)}, 1 << 30)[0]
    table = np.zeros((shard.blocks, 8), np.uint64)
    for lane in range(8):
        np.bitwise_or.at(table[:, lane], spelling.block_of(inside, shard), spelling.lane_bits(inside, lane))
    assert len(spelling.passes(table, inside, shard)) == len(inside)
    outside = rng.integers(0, (1 << 64) - 1, 1_000_000, np.uint64)
    assert len(spelling.passes(table, outside, shard)) < 1000


def test_edit_hashes_are_those_of_the_words():
    word = "aàbcc"
    letters = np.frombuffer(word.encode("latin-1"), np.uint8)[None, :]
    row, place, letter = spelling.replacements(letters, range(5))
    made = {word[:p] + chr(l) + word[p + 1 :] for p, l in zip(place, letter)}
    alphabet = spelling.LETTERS.decode("latin-1")
    assert made == {word[:i] + c + word[i + 1 :] for i in range(5) for c in alphabet if c > word[i]}
    assert len(alphabet) == 90 and not row.any()


def test_empty_tables(spark, variants):
    found = spelling.variant_groups(variants.where("doc_id < 0"))
    assert found.collect() == []
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.variant_groups(variants.where("doc_id = 4000")).collect() == []
