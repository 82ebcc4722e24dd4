"""Token counts without tokens: count-only Viterbi over Aho-Corasick matches.

The distinct marked words of a batch are laid out in one string. An Aho-Corasick automaton of the
vocabulary goes over it once and names every piece that ends at each place, the longest first; a
table keeps, per place, the best score of reaching it and the number of pieces on that way. The rules
for scores and ties are those of the tokenizer.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.unigram import (
    MARK,
    Vocabulary,
    default_model,
    groups,
    numbered,
    read_vocabulary,
)

# Bytes of text whose words are looked at together.
GROUP_BYTES = 16_000_000
# Characters of words laid out at once.
BLOB = 1_000_000
LINE_END = "\n"


def automaton_of(vocabulary: Vocabulary, characters: set[str]) -> ahocorasick.Automaton:
    """Pieces as (length, score, pieces they count), with the ``characters`` that are no piece."""
    automaton = ahocorasick.Automaton()
    for text, (_, score) in vocabulary.pieces.items():
        automaton.add_word(text, (len(text), score, 1))
    for character in characters:
        automaton.add_word(character, (1, vocabulary.unknown, len(character.encode())))
    automaton.make_automaton()
    return automaton


def count_words(words: list[str], automaton: ahocorasick.Automaton) -> np.ndarray:
    """Pieces of each word; words hold no line end, and every character is known to the automaton."""
    counts = np.zeros(len(words), np.int64)
    first = 0
    while first < len(words):
        size, last = 0, first
        while last < len(words) and (size < BLOB or last == first):
            size += len(words[last]) + 1
            last += 1
        blob = LINE_END.join(words[first:last])
        lengths = np.fromiter(map(len, words[first:last]), np.int64, last - first)
        ends = np.cumsum(lengths + 1) - 1
        # No score yet, but where words start.
        best: list[float | None] = [None] * (len(blob) + 1)
        for start in (ends - lengths).tolist():
            best[start] = 0.0
        pieces = [0] * (len(blob) + 1)
        for end, (length, score, count) in automaton.iter(blob):
            end += 1
            start = end - length
            total = best[start] + score
            known = best[end]
            if known is None or total > known:
                best[end] = total
                pieces[end] = pieces[start] + count
        counts[first:last] = np.array(pieces, np.int64)[ends]
        first = last
    return counts


def counts_of(texts: pa.Array, vocabulary: Vocabulary, automata: dict) -> np.ndarray:
    """Pieces of every text. ``automata`` keeps automata by the unknown characters they include."""
    keys, flat, edges = numbered(texts)
    # A line end is a byte piece and parts what is around it; it also parts words when laid out.
    counts = np.fromiter((key.count(LINE_END) for key in keys), np.int64, len(keys))
    parts, owners = [], []
    for number, key in enumerate(keys):
        for part in (MARK + key).split(LINE_END):
            if part:
                parts.append(part)
                owners.append(number)
    strange = {c for c in set().union(*parts) if c not in vocabulary.pieces}
    if not automata or strange - automata["strange"]:
        automata["strange"] = strange | automata.get("strange", set())
        automata["automaton"] = automaton_of(vocabulary, automata["strange"])
    np.add.at(counts, np.array(owners, np.int64), count_words(parts, automata["automaton"]))
    total = np.concatenate([[0], np.cumsum(counts[flat])])
    return total[edges[1:]] - total[edges[:-1]]


def counter(path: str | None = None):
    """A column function: the number of pieces of a text. Null counts as empty and has none."""
    vocabulary = read_vocabulary(path or default_model())

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        automata: dict = {}
        runs = groups(texts, GROUP_BYTES)
        return pa.array(
            np.concatenate([counts_of(run, vocabulary, automata) for run in runs]), pa.int64()
        )

    return count


def with_token_counts(
    docs: DataFrame, text: str = "text", name: str = "n_tokens", path: str | None = None
) -> DataFrame:
    """The documents with the number of pieces of their text. All rows and other columns stay."""
    return docs.withColumn(name, counter(path)(F.col(f"`{text}`")))
