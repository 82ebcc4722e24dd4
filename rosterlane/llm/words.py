"""Words of many texts at once, as hashes in arrays.

Everything works on the UTF-8 bytes of an Arrow column. Word hashes are polynomials of random byte
values modulo 2^64, mixed, so equal words have equal hashes on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[[9, 10, 11, 12, 13, 32]] = True
BYTE_VALUES = np.random.Generator(np.random.PCG64(20250101)).integers(1, 1 << 63, 256, np.uint64)
BASE = np.uint64(0x9E3779B97F4A7C15)
# Bytes of text worked on at once; a single longer text is cut at white space.
SLICE_BYTES = 1 << 20


def mix(codes: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    codes = (codes ^ (codes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    codes = (codes ^ (codes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return codes ^ (codes >> np.uint64(31))


def powers(count: int) -> np.ndarray:
    factors = np.full(max(count, 1), BASE, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def cut(data: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` bytes that end at white space."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and not SPACE_BYTES[data[end]]:
            stop = min(end + 4096, len(data))
            space = np.flatnonzero(SPACE_BYTES[data[end:stop]])
            end = end + int(space[0]) if len(space) else stop
        yield at, end
        at = end


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of one text."""
    inside = np.concatenate([[False], ~SPACE_BYTES[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words of one text."""
    starts, ends, codes = [], [], []
    for a, b in cut(data):
        part = data[a:b]
        first, last = word_spans(part)
        if not len(first):
            continue
        lengths = last - first
        # Place of every byte within its word: the hash must not depend on where the word lies.
        origin = np.zeros(b - a, np.int64)
        origin[first] = np.diff(first, prepend=0)
        place = np.arange(b - a) - np.cumsum(origin)
        weight = powers(int(lengths.max()) + 1)
        values = BYTE_VALUES[part] * weight[np.minimum(place, len(weight) - 1)]
        bounds = np.column_stack([first, last]).ravel()
        sums = np.add.reduceat(np.append(values, np.uint64(0)), bounds)[::2]
        starts.append(first + a)
        ends.append(last + a)
        codes.append(mix(sums ^ lengths.astype(np.uint64)))
    if not starts:
        empty = np.empty(0, np.int64)
        return empty, empty, np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(codes)


def text_bytes(texts: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of every text; null counts as empty."""
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        plain = chunk.cast(pa.large_binary())
        _, offsets, data = plain.buffers()
        edges = np.frombuffer(offsets, np.int64)[plain.offset : plain.offset + len(plain) + 1]
        body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        valid = plain.is_valid().to_numpy(zero_copy_only=False)
        for i in range(len(plain)):
            yield body[edges[i] : edges[i + 1]] if valid[i] else body[:0]
