"""SentencePiece encoding and decoding with a unigram vocabulary, by shared-prefix Viterbi.

The distinct marked words of a batch of texts are sorted, which makes them the leaves of a trie in
depth-first order. Going from one word to the next, everything up to their common prefix stays: the
best score of reaching each place, and the vocabulary matches still open there. Only the rest of the
word is worked on.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import fresh
from rosterlane.llm.unigram import (
    MARK,
    Vocabulary,
    default_model,
    groups,
    numbered,
    read_vocabulary,
)
from rosterlane.llm.words import text_bytes

END = ""
# Bytes of text whose words are sorted together.
GROUP_BYTES = 16_000_000


def vocabulary_trie(vocabulary: Vocabulary):
    """The root's look-up by character. It gives, for a character that goes on, the look-up of the
    next node (None where nothing goes on from there) and the piece that ends there, if any."""
    root: dict = {}
    for text, found in vocabulary.pieces.items():
        node = root
        for character in text:
            node = node.setdefault(character, {})
        node[END] = found

    def frozen(node: dict):
        found = node.pop(END, None)
        children = {character: frozen(child) for character, child in node.items()}
        return children.get if children else None, found

    return frozen(root)[0]


def shared_prefix_viterbi(words: Iterable[str], vocabulary: Vocabulary) -> Iterator[list[int]]:
    """The ids of each word; ``words`` are distinct and sorted.

    At every depth: the best score, the depth where the last piece starts, its id, and the open
    matches as (start, look-up). Matches are kept in the order of their starts, so that of equal
    scores the earliest start is met first and stays.
    """
    root = vocabulary_trie(vocabulary)
    unknown = vocabulary.unknown
    scores, starts, ids, opened = [0.0], [0], [-1], [[(0, root)]]
    last = ""
    for word in words:
        depth, most = 0, min(len(word), len(last))
        while depth < most and word[depth] == last[depth]:
            depth += 1
        del scores[depth + 1 :], starts[depth + 1 :], ids[depth + 1 :], opened[depth + 1 :]
        for at in range(depth, len(word)):
            character = word[at]
            best, start, piece, following = None, at, -1, []
            # The last match begins at this character; without it the character is no piece.
            found = None
            for begun, look_up in opened[at]:
                child = look_up(character)
                if child is None:
                    found = None
                    continue
                onward, found = child
                if onward is not None:
                    following.append((begun, onward))
                if found is not None:
                    score = scores[begun] + found[1]
                    if best is None or score > best:
                        best, start, piece = score, begun, found[0]
            if found is None:
                score = scores[at] + unknown
                if best is None or score > best:
                    best, start, piece = score, at, -1
            following.append((at + 1, root))
            scores.append(best)
            starts.append(start)
            ids.append(piece)
            opened.append(following)
        last = word
        found_ids: list[int] = []
        at = len(word)
        while at:
            start, piece = starts[at], ids[at]
            if piece >= 0:
                found_ids.append(piece)
            else:
                byte_ids = vocabulary.byte_ids
                found_ids += [byte_ids[b] for b in reversed(word[start:at].encode())]
            at = start
        found_ids.reverse()
        yield found_ids


def encode_batch(texts: pa.Array, vocabulary: Vocabulary) -> pa.ListArray:
    """The ids of every text of a batch; null and empty texts have none."""
    keys, flat, edges = numbered(texts)
    # Encoded in sorted order, kept by number.
    order = sorted(range(len(keys)), key=keys.__getitem__)
    sizes, pool = np.zeros(len(order), np.int64), array("i")
    where = np.zeros(len(order), np.int64)
    words = (MARK + keys[number] for number in order)
    for number, found in zip(order, shared_prefix_viterbi(words, vocabulary), strict=True):
        sizes[number], where[number] = len(found), len(pool)
        pool.extend(found)
    # Put together text by text, so that nothing but the result is as long as all ids.
    counts = np.add.reduceat(np.append(sizes[flat], 0), edges[:-1]) if len(edges) > 1 else sizes[:0]
    counts[edges[:-1] == edges[1:]] = 0
    offsets = np.concatenate([[0], np.cumsum(counts)])
    values, found = np.empty(offsets[-1], np.int32), np.frombuffer(pool, np.int32)
    for first, last, at, end in zip(
        edges[:-1].tolist(), edges[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(),
        strict=True,
    ):
        words_of = flat[first:last]
        size = sizes[words_of]
        begin = where[words_of] - (np.cumsum(size) - size)
        values[at:end] = found[np.arange(end - at) + np.repeat(begin, size)]
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def decoded_bytes(ids: np.ndarray, piece_bytes: list[bytes]) -> bytes:
    """The UTF-8 text of pieces: marks are blanks, and the one in front goes."""
    data = b"".join(map(piece_bytes.__getitem__, ids.tolist()))
    return data[1:] if data[:1] == b" " else data


def lists(batch: pa.ListArray) -> Iterator[np.ndarray]:
    """Every list of a batch; null counts as empty."""
    values = batch.flatten().to_numpy(zero_copy_only=False)
    sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes).tolist()
    for first, last in zip([0, *ends], ends, strict=False):
        yield values[first:last]


def encoder(path: str | None = None):
    """A column function: text to the ids of its pieces. Texts are never cut."""
    vocabulary = read_vocabulary(path or default_model())

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        # Batches are bounded by rows; of long texts a few are taken at a time.
        return pa.concat_arrays(
            [encode_batch(run, vocabulary) for run in groups(texts, GROUP_BYTES)]
        )

    return encode


def decoder(path: str | None = None):
    """A column function: ids to text, broken UTF-8 replaced; null is null."""
    vocabulary = read_vocabulary(path or default_model())

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        table = vocabulary.piece_bytes
        texts = [decoded_bytes(ids, table).decode(errors="replace") for ids in lists(batch)]
        valid = batch.is_valid().to_pylist()
        return pa.array([t if ok else None for t, ok in zip(texts, valid, strict=True)], pa.string())

    return decode


def codec(path: str | None = None):
    """A column function: text to (ids, same), the ids of its pieces and whether decoding them gives
    the text back, in one pass. Marks that a text holds come back as blanks, as the encoding cannot
    tell them apart; null is like the empty text."""
    vocabulary = read_vocabulary(path or default_model())
    schema = pa.struct([("ids", pa.list_(pa.int32())), ("same", pa.bool_())])

    @F.arrow_udf("struct<ids:array<int>,same:boolean>")
    def code(texts: pa.Array) -> pa.Array:
        table, mark, found = vocabulary.piece_bytes, MARK.encode(), []
        for run in groups(texts, GROUP_BYTES):
            ids = encode_batch(run, vocabulary)
            same = [
                decoded_bytes(one, table) == data.tobytes().replace(mark, b" ")
                for one, data in zip(lists(ids), text_bytes(run), strict=True)
            ]
            found.append(pa.StructArray.from_arrays([ids, pa.array(same, pa.bool_())], fields=list(schema)))
        return pa.concat_arrays(found)

    return code


def encoded(docs: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """The documents with the ids of their text's pieces. All rows and other columns stay."""
    return docs.withColumn(ids, encoder(path)(F.col(f"`{text}`")))


def decoded(docs: DataFrame, ids: str = "ids", text: str = "decoded", path: str | None = None) -> DataFrame:
    """The documents with the text that the ids stand for."""
    return docs.withColumn(text, decoder(path)(F.col(f"`{ids}`")))


def coded(
    docs: DataFrame,
    text: str = "text",
    ids: str = "ids",
    same: str = "round_trip",
    path: str | None = None,
) -> DataFrame:
    """The documents encoded, decoded again and compared: the ids, and whether the text came back."""
    (both,) = fresh(docs, "coded text")
    with_both = docs.withColumn(both, codec(path)(F.col(f"`{text}`")))
    parts = {ids: F.col(f"`{both}`.ids"), same: F.col(f"`{both}`.same")}
    return with_both.withColumns(parts).drop(both)
