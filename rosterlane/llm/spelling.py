"""Spelling variants: words of a corpus that differ by one letter, and the form each stands for.

The vocabulary, words of enough letters and occurrences, is put into blocked Bloom filters, one shard
per length of word. Every word's neighbours by one deletion, and by one replacement with a later
letter, are generated as hashes, each from the word's own hash in a few operations, and tested against
the shard of their length. (An insertion is the other side's deletion, a replacement with an earlier
letter the other side's replacement.) Only neighbours that a filter lets through are spelled out and
joined to the vocabulary, which leaves the real words.

A filter has a proven size: shards are put into rounds of at most ``filter_bytes``, larger shards cut
by hash; a round tests the words of its lengths. So what tasks are given does not grow with the corpus,
only the number of rounds does.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import kept_table
from rosterlane.llm.words import BASE, BYTE_VALUES, mix, powers

MIN_LETTERS = 5
MIN_COUNT = 3
# One in so many runs of a document loses a letter.
LOSS = 97
# A form has at least so many times the word's occurrences.
FORM_TIMES = 2

# All letters lie in Latin-1, so a word is a string of bytes, and bytes sort as code points do.
LETTERS = bytes([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)])
LOWERED = bytearray(b" " * 256)
for _letter in LETTERS:
    LOWERED[_letter] = _letter
for _letter in range(ord("A"), ord("Z") + 1):
    LOWERED[_letter] = _letter + 32

SLICE = 1 << 20
HELD_WORDS = 250_000

# Bits of a block lie in as many lanes of 64, one of a word in each.
LANES = 8
FILTER_BYTES = 32 << 20
# Lengths from here on share a shard with those of the same power of two.
LONG = 64
# Neighbours tested at once.
TESTED = 1 << 20
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


# ------------------------------------------------------------------------------- vocabulary


def lowered_runs(text: str) -> Iterator[list[bytes]]:
    """The runs of letters of a text, A to Z in lower case, slice by slice."""
    data = text.encode("latin-1", "replace").translate(LOWERED)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield (data if not at and end == len(data) else data[at:end]).split()
        at = end


def noisy_words(key: bytes, text: str, least: int) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of a document: its runs, of which some lose a letter by their checksum."""
    runs: Counter[bytes] = Counter()
    for part in lowered_runs(text):
        runs.update(part)
    start = zlib.crc32(key + b":")
    for run, n in runs.items():
        if len(run) < least:
            continue
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % LOSS == 0:
            place = h % len(run)
            run = run[:place] + run[place + 1 :]
            if len(run) < least:
                continue
        yield run, n


def vocabulary(
    docs: DataFrame, key: str, text: str, least: int = MIN_LETTERS, count: int = MIN_COUNT
) -> DataFrame:
    """(w, n): the words of the whole corpus as Latin-1 bytes, and how often each occurs.

    Tasks add up what they see before the shuffle, so a word that is everywhere is no burden.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, ["w", "n"])

        for batch in batches:
            for id_, value in zip(batch["key"], batch["text"]):
                for word, n in noisy_words((id_.as_py() or "").encode(), value.as_py() or "", least):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield flushed()
                    held = {}
        if held:
            yield flushed()

    chosen = docs.select(
        F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{text}`").cast("string").alias("text")
    )
    partial = chosen.where(F.col("text").isNotNull()).mapInArrow(counted, "w binary, n long")
    return partial.groupBy("w").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


# ---------------------------------------------------------------------------------- filters


def shard_of(length: int) -> int:
    """The shard of a length: the length itself, or for long words the least of its power of two."""
    return length if length < LONG else 1 << (length.bit_length() - 1)


@dataclass
class Shard:
    """Blocks ``start`` to ``start + blocks`` of a round's filter: the words of some lengths whose
    hash leaves ``part`` over when divided into ``parts``."""

    name: int
    parts: int
    part: int
    start: int
    blocks: int


def words_per_block(longest: int) -> float:
    """So few that less than one neighbour in eight of a word's own passes by chance."""
    return 64 * (8 * len(LETTERS) * (longest + 1.0)) ** (-1 / LANES)


def rounds(words: dict[int, int], filter_bytes: int) -> list[list[Shard]]:
    """Shards in rounds of at most ``filter_bytes``; ``words`` has the number of words per shard."""
    most = max(1, filter_bytes // (8 * LANES))
    out: list[list[Shard]] = []
    used = most
    for name, n in sorted(words.items()):
        longest = name if name < LONG else 2 * name
        blocks = max(1, int(np.ceil(n / words_per_block(longest))))
        parts = -(-blocks // most)
        each = -(-blocks // parts)
        for part in range(parts):
            if used + each > most:
                out.append([])
                used = 0
            out[-1].append(Shard(name, parts, part, used, each))
            used += each
    return out


def codes(hashes: np.ndarray, length: int) -> np.ndarray:
    return mix(hashes ^ np.uint64(length * 0x9E3779B97F4A7C15 & (1 << 64) - 1))


def block_of(code: np.ndarray, shard: Shard) -> np.ndarray:
    return np.int64(shard.start) + (((code >> np.uint64(32)) * np.uint64(shard.blocks)) >> np.uint64(32)).astype(np.int64)


def in_part(code: np.ndarray, shard: Shard) -> np.ndarray:
    return (code & np.uint64(0xFFFFFFFF)) % np.uint64(shard.parts) == shard.part


def lane_bits(code: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((mix(code + BASE) >> np.uint64(6 * lane)) & np.uint64(63))


def by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, indices, letters as a matrix) for every length."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        letters = np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), length)
        yield int(length), rows, letters


def hash_of(letters: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The sum of letter values times powers of the base, a few columns at a time."""
    total = np.zeros(len(letters), np.uint64)
    step = max(1, TESTED // len(letters))
    for i in range(0, letters.shape[1], step):
        part = BYTE_VALUES[letters[:, i : i + step]] * weight[i : i + step]
        total += part.sum(axis=1, dtype=np.uint64)
    return total


def filter_rows(words: DataFrame, shards: list[Shard]) -> DataFrame:
    """(block, lanes): the filter's blocks that are not empty."""
    lanes = [f"l{i}" for i in range(LANES)]

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, letters in by_length(batch["w"].to_pylist()):
                code = codes(hash_of(letters, powers(length)), length)
                for shard in shards:
                    if shard.name != shard_of(length):
                        continue
                    mine = code[in_part(code, shard)]
                    arrays = [block_of(mine, shard), *(lane_bits(mine, i).view(np.int64) for i in range(LANES))]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["block", *lanes])

    schema = ", ".join(f"{c} long" for c in ["block", *lanes])
    ored = [F.bit_or(c).alias(c) for c in lanes]
    return words.select("w").mapInArrow(bits, schema).groupBy("block").agg(*ored)


def passes(table: np.ndarray, code: np.ndarray, shard: Shard) -> np.ndarray:
    """Indices of the codes that the filter lets through; most fail at their first lane."""
    left = np.flatnonzero(in_part(code, shard)) if shard.parts > 1 else np.arange(len(code))
    block = block_of(code[left], shard)
    for lane in range(LANES):
        hit = (table[block, lane] & lane_bits(code[left], lane)) != 0
        left, block = left[hit], block[hit]
    return left


# ------------------------------------------------------------------------------- neighbours


def replacements(letters: np.ndarray, places: range) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, letter) of every replacement by a later letter."""
    alphabet = np.frombuffer(LETTERS, np.uint8)
    rank = np.searchsorted(alphabet, letters[:, places.start : places.stop])
    later = len(alphabet) - 1 - rank.ravel()
    cell = np.repeat(np.arange(rank.size), later)
    nth = np.arange(len(cell)) - np.repeat(np.cumsum(later) - later, later)
    width = len(places)
    return cell // width, cell % width + places.start, alphabet[rank.ravel()[cell] + 1 + nth]


def near_in(
    table: np.ndarray, shards: list[Shard], words: list[bytes]
) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """(indices of words, their neighbours spelled out) that the round's filter lets through."""
    by_name: dict[int, list[Shard]] = {}
    for shard in shards:
        by_name.setdefault(shard.name, []).append(shard)

    def spelled(matrix: np.ndarray) -> pa.Array:
        m, width = matrix.shape
        offsets = np.arange(0, (m + 1) * width, max(width, 1), dtype=np.int64)[: m + 1]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(matrix))]
        return pa.Array.from_buffers(pa.large_binary(), m, buffers).cast(pa.binary())

    for length, indices, all_letters in by_length(words):
        same, shorter = by_name.get(shard_of(length), ()), by_name.get(shard_of(length - 1), ())
        if not same and not shorter:
            continue
        weight = powers(length)
        step = max(1, TESTED // (len(LETTERS) // 2 * length))
        for a in range(0, len(indices), step):
            index, letters = indices[a : a + step], all_letters[a : a + step]
            whole = hash_of(letters, weight)
            if shorter:
                # Of equal letters in a row only the first is deleted.
                terms = BYTE_VALUES[letters] * weight
                ahead = np.cumsum(terms, axis=1, dtype=np.uint64)
                without = ahead - terms + (whole[:, None] - ahead) * UNBASE
                first = np.ones(letters.shape, bool)
                first[:, 1:] = letters[:, 1:] != letters[:, :-1]
                row, place = np.nonzero(first)
                code = codes(without[row, place], length - 1)
                for shard in shorter:
                    for part in parted(passes(table, code, shard), length):
                        keep = np.ones((len(part), length), bool)
                        keep[np.arange(len(part)), place[part]] = False
                        left = letters[row[part]][keep].reshape(len(part), length - 1)
                        yield index[row[part]], spelled(left)
            if not same:
                continue
            wide = max(1, TESTED // (len(LETTERS) * len(index)))
            for b in range(0, length, wide):
                row, place, letter = replacements(letters, range(b, min(b + wide, length)))
                old = letters[row, place]
                changed = whole[row] + (BYTE_VALUES[letter] - BYTE_VALUES[old]) * weight[place]
                code = codes(changed, length)
                for shard in same:
                    for part in parted(passes(table, code, shard), length):
                        changed_letters = letters[row[part]]
                        changed_letters[np.arange(len(part)), place[part]] = letter[part]
                        yield index[row[part]], spelled(changed_letters)


def parted(found: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """Parts whose spelled words have some MB together."""
    step = max(1, (4 << 20) // length)
    for a in range(0, len(found), step):
        yield found[a : a + step]


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(w, n, other, other_n): every two words that differ by one letter, in both directions."""
    spark = words.sparkSession
    name = F.expr(f"if(length(w) < {LONG}, length(w), cast(shiftleft(1L, cast(floor(log2(length(w))) as int)) as int))")
    sizes = {r["name"]: r["n"] for r in words.groupBy(name.alias("name")).agg(F.count("*").alias("n")).collect()}
    passed = None
    for shards in rounds(sizes, filter_bytes):
        table = np.zeros((shards[-1].start + shards[-1].blocks, LANES), np.uint64)
        held = sorted({s.name for s in shards})
        # A word is tested where its own length or the next shorter one is held.
        of_round = words.where(name.isin(held))
        filled = filter_rows(of_round, shards).toArrow()
        block = filled["block"].to_numpy()
        for i in range(LANES):
            table[block, i] = filled[f"l{i}"].to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast(table)
        asked = words.where(name.isin(held) | _shorter(name, held))

        def probe(batches: Iterator[pa.RecordBatch], shards=shards, shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for index, other in near_in(shared.value, shards, batch["w"].to_pylist()):
                    own = batch.select(["w", "n"]).take(pa.array(index))
                    yield pa.RecordBatch.from_arrays([*own.columns, other], ["w", "n", "other"])

        let_through = asked.mapInArrow(probe, "w binary, n long, other binary")
        passed = let_through if passed is None else passed.unionByName(let_through)
    if passed is None:
        return spark.createDataFrame([], "w binary, n long, other binary, other_n long")
    known = words.select(F.col("w").alias("other"), F.col("n").alias("other_n"))
    real = passed.join(known.hint("merge"), "other").select("w", "n", "other", "other_n")
    sides = F.explode(
        F.array(F.struct("w", "n", "other", "other_n"), F.struct(
            F.col("other").alias("w"), F.col("other_n").alias("n"), F.col("w").alias("other"), F.col("n").alias("other_n")
        ))
    )
    return real.select(sides.alias("side")).select("side.*")


def _shorter(name: Column, held: list[int]) -> Column:
    """The shard of a word without one letter is held."""
    shorter = F.expr(
        f"if(length(w) <= {LONG}, length(w) - 1, cast(shiftleft(1L, cast(floor(log2(length(w) - 1)) as int)) as int))"
    )
    return shorter.isin(held)


# -------------------------------------------------------------------------------------- forms


def roots(forms: DataFrame) -> DataFrame:
    """(w, root): from word to form to its form and so on, to the last.

    Every step at least doubles the occurrences, so there are few; each round jumps twice as far. Words
    that have arrived are not joined again.
    """
    going = kept_table(forms.select("w", F.col("form").alias("root")), "forms")
    far, arrived = going, None
    while True:
        ahead = far.select(F.col("w").alias("root"), F.col("root").alias("next"))
        jumped = kept_table(going.join(ahead.hint("merge"), "root", "left"), "forms")
        ended = jumped.where("next is null").select("w", "root")
        arrived = ended if arrived is None else arrived.unionByName(ended)
        going = jumped.where("next is not null").select("w", F.col("next").alias("root"))
        if going.isEmpty():
            return arrived
        far = going.unionByName(arrived)


def variant_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = MIN_LETTERS,
    count: int = MIN_COUNT,
    times: int = FORM_TIMES,
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a row per word of the corpus.

    Words are runs of Latin letters of whole texts with A to Z in lower case, where the checksum of key
    and run takes a letter from some; they have at least ``least`` letters and occur ``count`` times. Words
    are near if one differs from the other by exactly one letter more, less or other. A word's form is its
    near word of most occurrences (of equals the first in code-point order) if these are ``times`` its
    own; ``root`` is the last form reached from it, or the word. Null texts have no words, a null key
    counts as empty text, repeated rows count as often as they occur, other columns do not matter; an
    empty table gives no rows. Runs of any length are words like others.

    To the driver come the number of words per length class (at most a hundred rows) and, round by
    round, a filter of at most ``filter_bytes``.
    """
    words = kept_table(vocabulary(docs, key, text, least, count), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    nearest = near_pairs(words, filter_bytes).groupBy("w").agg(F.count("*").alias("n_near"), best)
    judged = words.join(nearest.hint("merge"), "w", "left").withColumn("form_n", -F.col("best.less"))
    strong = F.col("form_n") >= times * F.col("n")
    formed = kept_table(
        judged.select(
            "w", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(strong, F.col("best.other")).alias("form"), F.when(strong, F.col("form_n")).alias("form_n"),
        ),
        "formed",
    )
    ends = roots(formed.where("form is not null"))
    rooted = formed.join(ends.hint("merge"), "w", "left")
    spelled = [F.decode(c, "ISO-8859-1") for c in ("w", "form")]
    return rooted.select(
        spelled[0].alias("word"), spelled[1].alias("form"),
        F.decode(F.coalesce("root", "w"), "ISO-8859-1").alias("root"), "n", "n_near", "form_n",
    )
