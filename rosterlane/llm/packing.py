"""Packing documents into sequences of a fixed number of tokens, as few as it can.

Linear grouping: the lengths of the large pieces are cut along their order into groups of equal
cardinality, and each counts as the largest of its group. For these few sizes the best configurations
(which sizes share a sequence) come from a linear program, solved by column generation. The pieces
themselves take the places of their group, and what a piece is shorter than its place stays free. The
small pieces go, longest first, to the sequence of least free room that has enough for them.

All of this is worked out on the histogram of lengths, which has as many numbers as a sequence has
tokens, however many documents there are. The outcome is a list of patterns (lengths that share a
sequence) with the number of sequences of each. Every piece then finds its place from its length and
its number among the pieces of that length.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterlane.llm.common import kept_table, per_worker

CAPACITY = 4096
END_ID = 1
TOKENIZER = "word_bpe_49k.json"

# At most so many groups of large pieces. What counts as large, in parts of a sequence, is tried out:
# rounding leaves room that only small pieces can use, so how many of these there are decides.
GROUPS = 128
LARGE = (3 / 4, 1 / 2, 2 / 5, 1 / 4, 1 / 8)
# Steps of the linear program; it ends by itself far sooner, and any step's result is a packing.
PRICINGS = 3000

# White space that str.split() knows and the tokenizer takes for a sign.
SEPARATORS = re.compile("[\x1c-\x1f]")
ASCII_SPACE = re.compile("[ \t\n\r]+")
TAIL = ".,;:!?"
# Characters of text worked on at once, and words whose ids a worker remembers.
SLICE = 1 << 20
REMEMBERED = 500_000
FLUSH_BYTES = 4 << 20

Run = tuple[int, int]


# ------------------------------------------------------------------------------------- tokens


class WordIds:
    """Ids of a text, word by word: no token of this kind of vocabulary reaches over white space, so
    a text has the ids of its words in a row. Words are looked up where they have been met before."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = self.plain_letters()
        self.ascii_as_is = self.letters is not None and all(
            self.letters[ord(c)] == c for c in string.ascii_lowercase
        )
        self.tail = self.tail_signs()
        self.known: dict[str, bytes] = {}

    def plain_letters(self) -> dict[int, str] | None:
        """Of the Latin letters, how each is spelled in the vocabulary. None if the tokenizer does not
        lower-case letters and take a run of them as one word: then it has to see every word itself."""
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        letters = [c for c in map(chr, range(256)) if c.isalpha()]
        lowered = "".join(letters).lower()
        if normal is None or cut is None or normal.normalize_str("".join(letters)) != lowered:
            return None
        spelled = {ord(c): "".join(p for p, _ in cut.pre_tokenize_str(c)) for c in lowered}
        whole = [p for p, _ in cut.pre_tokenize_str(lowered)]
        return spelled if whole == [lowered.translate(spelled)] else None

    def tail_signs(self) -> str:
        """Signs that are tokens of their own after a Latin letter, whatever follows among them. Those
        that a token added to the vocabulary has are left out, as it is taken out of a text first."""
        added = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        signs = "".join(c for c in string.punctuation if c not in added)
        if self.letters is None or self.tokenizer.normalizer.normalize_str(signs) != signs:
            return TAIL

        def pieces(text: str) -> list[str]:
            return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

        apart = all(
            pieces(chr(c) + tail) == pieces(chr(c)) + pieces(tail)
            for c in self.letters
            for tail in (*signs, signs)
        )
        return signs if apart else TAIL

    def learn(self, words: list[str]) -> None:
        known, spelled, others = self.known, self.letters, []
        tokenize, as_is = self.model.tokenize, self.ascii_as_is
        for word in words:
            if spelled is not None and word.isalpha() and (word.isascii() or max(word) <= "\xff"):
                low = word.lower()
                if not (as_is and low.isascii()):
                    low = low.translate(spelled)
                known[word] = array("I", [t.id for t in tokenize(low)]).tobytes()
            else:
                others.append(word)
        if others:
            for word, ids in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
                known[word] = array("I", ids.ids).tobytes()

    def encode(self, words: list[str]) -> bytes:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, tail = self.known, self.tail
        ids = list(map(known.get, words))
        gaps = [i for i, found in enumerate(ids) if found is None]
        if gaps:
            new = {words[i] for i in gaps}
            # Signs after a letter are tokens of their own.
            cores = {w: w.rstrip(tail) for w in new if w[-1] in tail}
            last = "\x7f" if self.letters is None else "\xff"
            cores = {w: c for w, c in cores.items() if c and c[-1].isalpha() and c[-1] <= last}
            tails = {w[len(c) :] for w, c in cores.items()}
            self.learn([*(new - cores.keys()).union(cores.values(), tails).difference(known)])
            for word, core in cores.items():
                known[word] = known[core] + known[word[len(core) :]]
            for i in gaps:
                ids[i] = known[words[i]]
        return b"".join(ids)

    def of_text(self, text: str) -> Iterator[bytes]:
        """The ids of a text as little-endian unsigned 32-bit numbers, slice by slice."""
        at = 0
        while at < len(text):
            end = at + SLICE
            if end < len(text):
                space = ASCII_SPACE.search(text, end)
                end = space.start() if space else len(text)
            part = text[at:end] if at or end < len(text) else text
            cut = ASCII_SPACE.split(part) if SEPARATORS.search(part) else part.split()
            yield self.encode([word for word in cut if word] if "" in cut[:1] + cut[-1:] else cut)
            at = end


def tokenizer_path(path: str | None) -> str:
    """``path``, or the place of the public vocabulary on the machine that asks."""
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def cut_pieces(
    docs: DataFrame, key: str, text: str, capacity: int, end_id: int, tokenizer: str | None
) -> DataFrame:
    """(key, piece, start, length, ids, task, nth): the pieces of every document.

    ``nth`` numbers the pieces of one length within the task that cut them.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind)])
    for name, type_ in (("piece", "integer"), ("start", "long"), ("length", "integer"), ("ids", "binary"), ("task", "integer"), ("nth", "long")):
        schema.add(name, type_)
    width = 4 * capacity
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(tokenizer)
        words = per_worker(f"word ids {path}", lambda: WordIds(path))
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple[int, int, bytes]] = []
            size = 0

            def flushed() -> pa.RecordBatch:
                lengths = np.array([len(ids) // 4 for _, _, ids in rows], np.int64)
                nth = np.empty(len(rows), np.int64)
                for i, length in enumerate(lengths):
                    nth[i] = seen[length]
                    seen[length] += 1
                piece = np.array([p for _, p, _ in rows], np.int64)
                arrays = [
                    batch["key"].take(pa.array([r for r, _, _ in rows], pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(piece * capacity),
                    pa.array(lengths, pa.int32()),
                    pa.array([ids for _, _, ids in rows], pa.binary()),
                    pa.array(np.full(len(rows), task), pa.int32()),
                    pa.array(nth),
                ]
                return pa.RecordBatch.from_arrays(arrays, schema.names)

            for row, value in enumerate(batch["text"]):
                piece, rest = 0, b""
                for ids in words.of_text(value.as_py() or ""):
                    rest += ids
                    at = 0
                    # What is left always has room for the end.
                    while len(rest) - at >= width:
                        rows.append((row, piece, rest[at : at + width]))
                        size, piece, at = size + width, piece + 1, at + width
                        if size > FLUSH_BYTES:
                            yield flushed()
                            rows, size = [], 0
                    rest = rest[at:]
                rows.append((row, piece, rest + end))
                size += len(rest) + 4
                if size > FLUSH_BYTES:
                    yield flushed()
                    rows, size = [], 0
            if rows:
                yield flushed()

    chosen = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return chosen.mapInArrow(cut, schema)


# ------------------------------------------------------------------------------- the packing


@dataclass
class Pattern:
    """Runs of (length, how many) that share a sequence, and the number of such sequences."""

    runs: tuple[Run, ...]
    count: int


def linear_groups(counts: np.ndarray, groups: int) -> list[list[Run]]:
    """Pieces by falling length, in groups of equal cardinality (the last may be smaller): per group
    its runs (length, pieces). One length may lie in several groups. Where there are no more lengths
    than groups, each is a group and nothing is rounded."""
    lengths = np.flatnonzero(counts)[::-1]
    if len(lengths) <= groups:
        return [[(int(length), int(counts[length]))] for length in lengths]
    total = int(counts.sum())
    each = max(1, -(-total // groups))
    out: list[list[Run]] = []
    room = 0
    for length in lengths:
        left = int(counts[length])
        while left:
            if not room:
                out.append([])
                room = each
            take = min(left, room)
            out[-1].append((int(length), take))
            left, room = left - take, room - take
    return out


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """How often to take every size for the highest sum of values within the capacity."""
    stages = np.zeros((len(sizes) + 1, capacity + 1))
    for j, (size, value) in enumerate(zip(sizes, values)):
        best = stages[j].copy()
        if value > 0:
            for _ in range(capacity // size):
                np.maximum(best[size:], best[:-size] + value, out=best[size:])
        stages[j + 1] = best
    taken = np.zeros(len(sizes), np.int64)
    room = capacity
    for j in range(len(sizes) - 1, -1, -1):
        while room >= sizes[j] and stages[j + 1][room] > stages[j][room] + 1e-12:
            taken[j] += 1
            room -= sizes[j]
    return taken


def configurations(sizes: np.ndarray, wanted: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how many sequences use each, for exactly the wanted number of every size.

    The linear program starts with configurations of one size and takes in the most valuable one until
    none is worth more than a sequence. Its numbers are rounded down; the few places that are then
    missing are filled longest first.
    """
    n = len(sizes)
    basis = np.diag(capacity // sizes).astype(float)
    for _ in range(PRICINGS):
        prices = np.linalg.solve(basis.T, np.ones(n))
        new = best_configuration(sizes, prices, capacity)
        if prices @ new <= 1 + 1e-7:
            break
        used, step = np.linalg.solve(basis, wanted), np.linalg.solve(basis, new)
        ratio = np.where(step > 1e-9, np.maximum(used, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = new
    used = np.floor(np.linalg.solve(basis, wanted) + 1e-6).astype(np.int64)
    left = wanted.astype(np.int64).copy()
    out = []
    for column, count in zip(basis.T.round().astype(np.int64), used):
        over = column > 0
        count = min(int(count), int((left[over] // column[over]).min()))
        if count > 0:
            out.append((column, count))
            left -= column * count
    while left.any():
        column, room = np.zeros(n, np.int64), capacity
        for j in np.argsort(-sizes, kind="stable"):
            column[j] = min(left[j], room // sizes[j])
            room -= column[j] * sizes[j]
        over = column > 0
        count = int((left[over] // column[over]).min())
        out.append((column, count))
        left -= column * count
    return out


def substituted(chosen: list[tuple[np.ndarray, int]], groups: list[list[Run]]) -> list[Pattern]:
    """Patterns of real lengths: every place of a configuration is taken by the next pieces of its
    group. Sequences that come out alike are one pattern."""
    rest = [list(reversed(group)) for group in groups]

    def take(group: int, count: int) -> list[Run]:
        out = []
        while count:
            length, pieces = rest[group].pop()
            used = min(pieces, count)
            if used < pieces:
                rest[group].append((length, pieces - used))
            out.append((length, used))
            count -= used
        return out

    patterns = []
    for column, count in chosen:
        places = [take(j, count) for j in range(len(column)) for _ in range(column[j])]
        ends = sorted({int(e) for place in places for e in np.cumsum([n for _, n in place])})
        at = [0] * len(places)
        used = [0] * len(places)
        start = 0
        for end in ends:
            held: dict[int, int] = {}
            for i, place in enumerate(places):
                length, pieces = place[at[i]]
                held[length] = held.get(length, 0) + 1
                used[i] += end - start
                if used[i] == pieces:
                    at[i], used[i] = at[i] + 1, 0
            patterns.append(Pattern(tuple(sorted(held.items(), reverse=True)), end - start))
            start = end
    return patterns


def with_small(patterns: list[Pattern], counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Add pieces to the patterns, longest first, each to the sequence of least room that has enough;
    a new sequence where none has. Sequences of equal room are handled together."""
    by_room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, bool)

    def put(runs: tuple[Run, ...], count: int, room: int) -> None:
        if count:
            by_room[room].append(Pattern(runs, count))
            filled[room] = True

    for p in patterns:
        put(p.runs, p.count, capacity - sum(length * n for length, n in p.runs))
    for length in np.flatnonzero(counts)[::-1]:
        length, left = int(length), int(counts[length])
        for room in length + np.flatnonzero(filled[length:]):
            room = int(room)
            # A sequence that has taken one piece is still the one of least room, so it is filled up.
            each = room // length
            while left and by_room[room]:
                p = by_room[room].pop()
                full = min(p.count, left // each)
                put((*p.runs, (length, each)), full, room - each * length)
                left -= full * each
                spare = p.count - full
                if spare and left:
                    put((*p.runs, (length, left)), 1, room - left * length)
                    spare, left = spare - 1, 0
                if spare:
                    by_room[room].append(Pattern(p.runs, spare))
            filled[room] = bool(by_room[room])
            if not left:
                break
        each = capacity // length
        put(((length, each),), left // each, capacity - each * length)
        if left % each:
            put(((length, left % each),), 1, capacity - left % each * length)
    return [p for held in by_room for p in held]


def grouped_packing(counts: np.ndarray, capacity: int, groups: int, cut: int) -> list[Pattern]:
    """The packing with pieces of over ``cut`` tokens in groups."""
    large = counts.copy()
    large[: cut + 1] = 0
    patterns: list[Pattern] = []
    if large.any():
        grouped = linear_groups(large, groups)
        sizes = np.array([group[0][0] for group in grouped], np.int64)
        wanted = np.array([sum(n for _, n in group) for group in grouped], float)
        patterns = substituted(configurations(sizes, wanted, capacity), grouped)
    return with_small(patterns, counts - large, capacity)


def packing(counts: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS) -> list[Pattern]:
    """Patterns that hold exactly ``counts[length]`` pieces of every length from 1 to the capacity:
    of the cuts between large and small the one that needs the fewest sequences."""
    least = -(-int(counts @ np.arange(capacity + 1)) // capacity)
    best: list[Pattern] = []
    fewest = None
    for part in LARGE:
        found = grouped_packing(counts, capacity, groups, int(part * capacity))
        used = sum(p.count for p in found)
        if fewest is None or used < fewest:
            best, fewest = found, used
        if fewest == least:
            break
    return best


@dataclass
class Places:
    """Where the pieces of every length go: runs of places, sorted by length and number."""

    base: np.ndarray  # per length: the number of shorter pieces
    first: np.ndarray  # per run: pieces of all runs before it
    each: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    sequence: np.ndarray

    def of(self, lengths: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the number-th piece of a length."""
        at = self.base[lengths] + number
        run = np.searchsorted(self.first, at, side="right") - 1
        within = at - self.first[run]
        each = self.each[run]
        return self.sequence[run] + within // each, self.offset[run] + within % each * self.length[run]


def places(patterns: list[Pattern], capacity: int) -> Places:
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for length, each in p.runs:
            rows.append((length, each, offset, sequence, each * p.count))
            offset += length * each
        sequence += p.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    pieces = np.zeros(capacity + 1, np.int64)
    np.add.at(pieces, table[:, 0], table[:, 4])
    return Places(
        base=np.cumsum(pieces) - pieces,
        first=np.cumsum(table[:, 4]) - table[:, 4],
        each=table[:, 1],
        offset=table[:, 2],
        length=table[:, 0],
        sequence=table[:, 3],
    )


# ----------------------------------------------------------------------------------- operator


def packed(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    groups: int = GROUPS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, piece, start, length, ids, ids_crc32, sequence_id, offset): a row per piece.

    A document is the ids of its text and then ``end_id``; a null or empty text has that one alone.
    Documents of more than ``capacity`` ids are cut into pieces of that many, and only the last may be
    shorter. ``ids`` are little-endian unsigned 32-bit numbers, ``ids_crc32`` their unsigned CRC-32.
    Sequences are numbered from 0, and their pieces lie without gaps from offset 0. Repeated rows, and
    rows without a key, are documents of their own; an empty table gives no rows. Other columns do not
    matter. ``tokenizer`` is a file of the ``tokenizers`` library whose tokens do not reach over white
    space, as all that split words there; by default the public word vocabulary.

    Texts are encoded once and written with their ids to the shared folder. Only the histogram of
    lengths (``capacity`` numbers) comes to the driver, and the places of the patterns go to the tasks:
    their number depends on ``capacity`` and ``groups`` alone.
    """
    cut = kept_table(cut_pieces(docs, key, text, capacity, end_id, tokenizer), "pieces")
    per_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        histogram[length] = n
    plan = places(packing(histogram, capacity, groups), capacity)

    # Numbers among all pieces of a length: those of the tasks before, and the number in the task.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    crc = F.crc32("ids").alias("ids_crc32")
    numbered = cut.select("*", crc).join(before.hint("merge"), ["task", "length"])
    rows = numbered.select(
        "key", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32",
        (F.col("before") + F.col("nth")).alias("number"),
    )

    spots = F.pandas_udf(
        lambda length, number: _spots(plan, length, number), "sequence_id long, offset long"
    )
    spot = rows.withColumn("spot", spots("length", "number"))
    return spot.select(
        F.col("key").alias(key), "piece", "start", "length", "ids", "ids_crc32", "spot.sequence_id", "spot.offset"
    )


def _spots(plan: Places, length, number):
    import pandas as pd

    sequence, offset = plan.of(length.to_numpy(), number.to_numpy())
    return pd.DataFrame({"sequence_id": sequence, "offset": offset})
