"""A unigram vocabulary with byte fallback, as SentencePiece models hold it, and its rules.

Of the ways to reach a place in a text that of the highest sum of scores wins; among equal sums, that
whose last piece starts first. Sums are double-precision numbers. A character that is no piece costs
the lowest score less 10 and becomes its UTF-8 bytes. The model's scores are read as unigram scores,
whatever algorithm the model names.

Texts are cut into marked words: white space marks (U+2581 for every blank, one more in front of the
text) with what follows them. No piece goes on beyond a mark that follows a character, so a text's
best pieces are those of its words. Scores start anew in every word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*")
UNKNOWN_PENALTY = 10.0
NORMAL, BYTE = 1, 6

@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id: text, score and whether the piece takes part in matching, is a byte or neither."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]

    @cached_property
    def pieces(self) -> dict[str, tuple[int, float]]:
        return {
            t: (i, s)
            for i, (t, s, k) in enumerate(zip(self.texts, self.scores, self.kinds, strict=True))
            if k == NORMAL
        }

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == BYTE}

    @cached_property
    def unknown(self) -> float:
        return min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY

    @cached_property
    def piece_bytes(self) -> list[bytes]:
        """What each id stands for in a decoded text; control pieces stand for nothing."""
        found = [b""] * len(self.texts)
        for text, (i, _) in self.pieces.items():
            found[i] = text.replace(MARK, " ").encode()
        for value, i in self.byte_ids.items():
            found[i] = bytes([value])
        return found


def default_model() -> str:
    """The public model file at hand."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> Vocabulary:
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    pieces = model.pieces
    found = Vocabulary(
        tuple(p.piece for p in pieces), tuple(p.score for p in pieces), tuple(p.type for p in pieces)
    )
    crossing = [t for t in found.pieces if MARK in t.lstrip(MARK)]
    if crossing or len(found.byte_ids) != 256:
        raise ValueError(f"{path}: words can't be cut at marks, or bytes are missing")
    return found


def word_keys(text: str | None) -> list[str]:
    """The marked words of a text, each without its first mark; null and empty texts have none."""
    if not text:
        return []
    return [word[1:] for word in WORD.findall(MARK + text.replace(" ", MARK))]


def numbered(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct word keys of texts, the number of every word, and where each text's words start
    among them (with the end)."""
    filled = texts.fill_null("")
    split = pc.split_pattern(filled, " ")
    encoded = split.flatten().dictionary_encode()
    numbers = encoded.indices.to_numpy(zero_copy_only=False)
    sizes = split.value_lengths().to_numpy(zero_copy_only=False).copy()
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    keys = encoded.dictionary.to_pylist()
    # Several blanks in a row, blanks at an end and marks in the text take a closer look.
    odd = np.array([not key or MARK in key for key in keys], bool)
    rows = np.unique(np.searchsorted(edges, np.flatnonzero(odd[numbers]), side="right") - 1)
    if not len(rows):
        return keys, numbers, edges
    known = {key: number for number, key in enumerate(keys)}
    pieces, at = [], 0
    for row in rows.tolist():
        found = [known.setdefault(key, len(known)) for key in word_keys(filled[row].as_py())]
        pieces += [numbers[at : edges[row]], np.array(found, numbers.dtype)]
        sizes[row], at = len(found), edges[row + 1]
    numbers = np.concatenate([*pieces, numbers[at:]])
    return list(known), numbers, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def groups(texts: pa.Array, characters: int) -> Iterator[pa.Array]:
    """The texts in runs of about so many bytes; a longer text is a run of its own."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // characters
    edges = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(texts)]
    for first, last in zip(edges, edges[1:], strict=False):
        yield texts.slice(first, last - first)
