"""Removal of repeated passages: windows of words that occur earlier in the corpus.

Repeats are found level by level. Windows of a few words are looked at first; those that occur more
than once are extended to twice their length, and so on, until the wanted length is reached or no
candidate is left. A level only looks at one window inside each candidate, the one of the smallest
hash, which equal candidates share: that is a small part of all windows.

Documents are gathered into chunks by their id, so a chunk's place in the order of ids is known. A
chunk of too many rows or bytes, as of one id or of none, is cut into parts along the order of its
documents; each part is a chunk of its own. What meets elsewhere are hashes: each chunk sends a hash once, dealt by its value, and hears which of its
hashes other chunks (on the last level: earlier chunks) have too. A passage that a third of all
documents share is thereby sent once per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import kept_table, partitions
from rosterlane.llm.words import mix, text_bytes, word_hashes

WINDOW = 20
FIRST = 5
# Documents that form a chunk, where ids are spread evenly: their range of ids is taken from the data.
CHUNK_IDS = 256
# Bytes of text whose hashes go to one bucket.
BUCKET_BYTES = 32 << 20
# Rows and bytes of text of a chunk at most; a longer text is a chunk by itself.
CHUNK_ROWS = 4096
CHUNK_BYTES = 16 << 20
# Characters of a text that range bounds are made of.
PREFIX = 1000
QUESTION = "bucket long, chunk long, part long, hashes binary"
ANSWER = "chunk long, part long, hashes binary"
RESULT = "doc_id long, n_words long, removed_spans array<struct<start:int,end:int>>, text string"
# Of the two kinds of hashes.
FACTORS = (
    (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)),
    (np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)),
)


def levels(window: int, first: int) -> list[int]:
    """Lengths from ``first`` on, each twice the one before, the last being the window.

    Where doubling does not meet the window, the last step is shorter: a window is then known by its
    two halves overlapping.
    """
    found = [min(first, window)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


def hashes_of(codes: np.ndarray, lengths: list[int], kind: int = 0) -> list[np.ndarray]:
    """Per level the hash of the window that starts at each word (as far as there is one)."""
    left, right = FACTORS[kind]
    size = lengths[0]
    count = max(0, len(codes) - size + 1)
    first = np.zeros(count, np.uint64)
    for j in range(size):
        first = mix(first * left + codes[j : j + count])
    out = [first]
    for length in lengths[1:]:
        last, step = out[-1], length - size
        count = max(0, len(codes) - length + 1)
        out.append(mix(last[:count] * left + last[step : step + count] * right))
        size = length
    return out


def window_hashes(codes: np.ndarray, lengths: list[int]) -> np.ndarray:
    """The 128-bit hashes of the windows of full length: a row of two numbers each."""
    return np.column_stack([hashes_of(codes, lengths, kind)[-1] for kind in range(2)])


def different(rows: np.ndarray) -> np.ndarray:
    """The different rows, sorted."""
    if rows.shape[1] == 1:
        return np.unique(rows)[:, None]
    rows = rows[np.lexsort(rows.T[::-1])]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return rows[new]


def seen_before(rows: np.ndarray) -> np.ndarray:
    """Which rows are equal to an earlier one."""
    _, first, number = np.unique(rows[:, 0], return_index=True, return_inverse=True)
    first = first[number.ravel()]
    if (rows != rows[first]).any():
        # Two windows share the first number by chance.
        order = np.lexsort(rows.T[::-1])
        again = np.zeros(len(rows), bool)
        again[order[1:]] = (rows[order[1:]] == rows[order[:-1]]).all(axis=1)
        return again
    return first != np.arange(len(rows))


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` values in a row."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def within(rows: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which rows are among the sorted different rows ``known``."""
    found = np.zeros(len(rows), bool)
    if not len(known):
        return found
    values, heads = rows[:, 0], np.ascontiguousarray(known[:, 0])
    place = np.searchsorted(heads, values)
    # As many rows as share a first number, which is one but for chance.
    same = np.flatnonzero(np.diff(heads, prepend=~heads[:1]))
    for step in range(int(np.diff(same, append=len(heads)).max())):
        at = np.minimum(place + step, len(heads) - 1)
        found |= (known[at] == rows).all(axis=1)
    return found


def unpacked(blobs: list[bytes], width: int) -> np.ndarray:
    return different(np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width))


def in_order(ids: list[int | None], texts: list[str | None]) -> list[int]:
    """Places of the rows in the order of documents: by id, null first, then by text."""
    return sorted(
        range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i] or "")
    )


def sent(key: tuple, hashes: np.ndarray, buckets: int) -> pa.Table:
    """A chunk's distinct hashes, a row per bucket."""
    hashes = different(hashes)
    bucket = (hashes[:, 0] >> np.uint64(33)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    hashes, bucket = hashes[order], bucket[order]
    used, starts = np.unique(bucket, return_index=True)
    parts = np.split(hashes, starts[1:]) if len(used) else []
    chunk, part = (k.as_py() for k in key)
    return pa.table({
        "bucket": pa.array(used.astype(np.int64)),
        "chunk": pa.array([chunk] * len(used), pa.int64()),
        "part": pa.array([part] * len(used), pa.int64()),
        "hashes": pa.array([p.tobytes() for p in parts], pa.binary()),
    })


def answered(table: pa.Table, later_only: bool, width: int) -> pa.Table:
    """Of a bucket's hashes (of ``width`` numbers), those that several chunks have, a row per chunk
    that hears of any.

    ``later_only``: the first of the chunks does not hear of a hash.
    """
    blobs = table["hashes"].to_pylist()
    places = np.column_stack([table["chunk"].to_numpy(), table["part"].to_numpy()])
    places, number = np.unique(places, axis=0, return_inverse=True)
    chunks = np.repeat(number.ravel(), [len(b) // (8 * width) for b in blobs])
    hashes = np.frombuffer(b"".join(blobs), np.uint64).reshape(-1, width)
    order = np.lexsort((chunks, *hashes.T[::-1]))
    hashes, chunks = hashes[order], chunks[order]
    # A chunk may have been sent in parts.
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]).any(axis=1) | (chunks[1:] != chunks[:-1])
    hashes, chunks = hashes[new], chunks[new]
    same = (hashes[1:] == hashes[:-1]).all(axis=1)
    told = np.zeros(len(hashes), bool)
    told[1:] |= same
    if not later_only:
        told[:-1] |= same
    hashes, chunks = hashes[told], chunks[told]
    order = np.argsort(chunks, kind="stable")
    hashes, chunks = hashes[order], chunks[order]
    used, starts = np.unique(chunks, return_index=True)
    parts = np.split(hashes, starts[1:]) if len(used) else []
    return pa.table({
        "chunk": pa.array(places[used, 0], pa.int64()),
        "part": pa.array(places[used, 1], pa.int64()),
        "hashes": pa.array([p.tobytes() for p in parts], pa.binary()),
    })


def covered(removed: np.ndarray, window: int, n_words: int) -> np.ndarray:
    """Which words lie in a removed window."""
    edges = np.zeros(n_words + 1, np.int64)
    starts = np.flatnonzero(removed)
    edges[starts] += 1
    np.add.at(edges, starts + window, -1)
    return np.cumsum(edges[:-1]) > 0


def width_of(level: int, lengths: list[int]) -> int:
    """Numbers of a hash on a level."""
    return 2 if level == len(lengths) - 1 else 1


def questions(table: pa.Table, told: pa.Table | None, lengths: list[int], level: int) -> np.ndarray:
    """The hashes that a chunk asks about on a level: of every window that is still a candidate the
    smallest hash of the level's windows inside it, and on the last level its own. ``told`` answers the
    level before."""
    window, width = lengths[-1], width_of(level, lengths)
    known = unpacked(told["hashes"].to_pylist(), 1) if told is not None else None
    picked = [np.empty((0, width), np.uint64)]
    for data in text_bytes(table["text"]):
        codes = word_hashes(data)[2]
        if len(codes) < window:
            continue
        every = hashes_of(codes, lengths[: level + 1])
        candidate = None
        if known is not None:
            before = lowest(every[level - 1], window - lengths[level - 1] + 1)
            candidate = within(before[:, None], known)
            if not candidate.any():
                continue
        if width == 2:
            seeds = window_hashes(codes, lengths)
        else:
            seeds = lowest(every[level], window - lengths[level] + 1)[:, None]
        picked.append(different(seeds if candidate is None else seeds[candidate]))
    return np.concatenate(picked)


def asking(lengths: list[int], buckets: int):
    """What a chunk sends on the first level."""

    def ask(key: tuple, texts: pa.Table) -> pa.Table:
        return sent(key, questions(texts, None, lengths, 0), buckets)

    return ask


def asking_on(lengths: list[int], buckets: int, level: int):
    """What a chunk sends on a later level, having heard of the one before."""

    def ask(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        return sent(key, questions(texts, told, lengths, level), buckets)

    return ask


def answering(lengths: list[int], level: int):
    """What a bucket says on a level."""

    def answer(table: pa.Table) -> pa.Table:
        return answered(table, level == len(lengths) - 1, width_of(level, lengths))

    return answer


def cleaned(table: pa.Table, told: pa.Table, lengths: list[int]) -> pa.Table:
    """The texts of a chunk without repeated windows; ``told`` are the hashes of earlier chunks."""
    window = lengths[-1]
    ids, texts = table["doc_id"].to_pylist(), list(text_bytes(table["text"]))
    order = in_order(ids, table["text"].to_pylist())
    codes = [word_hashes(texts[i])[2] for i in order]
    windows = [window_hashes(c, lengths) for c in codes]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in windows])]).astype(int)
    flat = np.concatenate([np.empty((0, 2), np.uint64), *windows])
    repeated = seen_before(flat) | within(flat, unpacked(told["hashes"].to_pylist(), 2))
    n_words, spans, kept = [], [], []
    for place, i in enumerate(order):
        words = texts[i].tobytes().split()
        gone = covered(repeated[bounds[place] : bounds[place + 1]], window, len(words))
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False)).tolist()
        spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        n_words.append(len(words))
        left = [w for w, out in zip(words, gone.tolist(), strict=True) if not out] if edges else words
        kept.append(b" ".join(left).decode())
    return pa.table({
        "doc_id": pa.array([ids[i] for i in order], pa.int64()),
        "n_words": pa.array(n_words, pa.int64()),
        "removed_spans": pa.array(
            spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        ),
        "text": pa.array(kept, pa.string()),
    })


def numbering(rows_at_most: int, bytes_at_most: int):
    """Numbers the parts of chunks in sorted rows; ``part`` holds the task and becomes its number."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, part, rows, size = None, 0, 0, 0
        for batch in batches:
            found = []
            tasks, chunks = batch["part"].to_pylist(), batch["chunk"].to_pylist()
            for task, at, more in zip(tasks, chunks, batch["size"].to_pylist(), strict=True):
                if at != chunk or rows >= rows_at_most or size + more > bytes_at_most:
                    chunk, part, rows, size = at, part + 1, 0, 0
                rows, size = rows + 1, size + more
                found.append((task << 32) + part)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text"], batch["chunk"], pa.array(found, pa.int64())],
                ["doc_id", "text", "chunk", "part"],
            )

    return number


def range_of_ids(docs: DataFrame, chunk_ids: int) -> int:
    """How many ids in a row belong to about ``chunk_ids`` documents, where most of them lie: as many
    for dense ids, more for hashed ones. Ranges that hold far more documents are cut anyhow."""
    ids = F.col("doc_id").cast("long")
    bounds = F.percentile_approx(ids, [0.1, 0.9], 1000).alias("bounds")
    rows, bounds = docs.where(ids.isNotNull()).agg(F.count("*"), bounds).first()
    if not rows:
        return chunk_ids
    width = -(-chunk_ids * (bounds[1] - bounds[0]) * 10 // (8 * rows))
    return min(max(chunk_ids, width), 1 << 62)


def in_chunks(
    docs: DataFrame, chunk_ids: int, chunk_rows: int, chunk_bytes: int
) -> tuple[DataFrame, int]:
    """(doc_id, text, chunk, part): every row's chunk and the part of it, ordered as documents are;
    and the bytes of all texts.

    Chunks within the bounds are one part. The rows of others are dealt by ranges of the order, sorted,
    and numbered in turn. Range bounds hold a text's first characters; rows equal in id and text, if
    not longer than those, are dealt further by the task that reads them, so one id and text may fill
    several ranges. These rows are written to the shared folder, as numbers must not change.
    """
    spark = docs.sparkSession
    # Division that rounds down, in whole numbers: a double does not hold every id.
    width = range_of_ids(docs, chunk_ids)
    chunk = F.coalesce(
        F.expr(f"doc_id div {width}L - if(doc_id % {width}L < 0, 1L, 0L)"), F.lit(-(1 << 62))
    ).cast("long")
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("chunk", chunk)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    sizes = body.groupBy("chunk").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    is_large = (F.col("rows") > 1) & ((F.col("rows") > chunk_rows) | (F.col("bytes") > chunk_bytes))
    rows, total, all_bytes = sizes.agg(
        F.sum(F.when(is_large, F.col("rows"))), F.sum(F.when(is_large, F.col("bytes"))), F.sum("bytes")
    ).first()
    whole = body.withColumn("part", F.lit(0).cast("long"))
    if not rows:
        return whole, all_bytes or 0
    large = kept_table(sizes.where(is_large).select("chunk"), "large-chunks")
    known = F.coalesce("text", F.lit(""))
    ranges = min(partitions(spark), 1 + rows // chunk_rows + total // chunk_bytes)
    sized = body.join(large, "chunk", "left_semi").select(
        "doc_id",
        "text",
        "chunk",
        size.alias("size"),
        F.substring(known, 1, PREFIX).alias("prefix"),
        # Texts that go on after the prefix follow those that end there.
        F.when(F.length(known) <= PREFIX, F.spark_partition_id())
        .otherwise(F.lit((1 << 31) - 1))
        .alias("copy"),
    )
    ordered = sized.repartitionByRange(
        ranges, "chunk", "doc_id", "prefix", "copy"
    ).sortWithinPartitions("chunk", "doc_id", known)
    cut = ordered.select(
        "doc_id", "text", "chunk", "size", F.spark_partition_id().cast("long").alias("part")
    ).mapInArrow(
        numbering(chunk_rows, chunk_bytes), "doc_id long, text string, chunk long, part long"
    )
    small = whole.join(large, "chunk", "left_anti").select("doc_id", "text", "chunk", "part")
    return small.unionByName(kept_table(cut, "cut-chunks")), all_bytes


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    first: int = FIRST,
    chunk_ids: int = CHUNK_IDS,
    chunk_rows: int = CHUNK_ROWS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, removed_spans, text): every text without the words of repeated windows.

    A window of ``window`` words is repeated when its words start earlier too: in a document of
    smaller id, or earlier in the same one. Rows of one id are ordered by text, rows without an id
    come first. Windows are judged on the texts as they are. ``removed_spans`` holds the maximal
    ranges of removed words (start, end; end exclusive) and ``text`` the kept words joined by one
    space. Null texts count as empty; every row comes back.

    Windows are compared by 128-bit hashes. Documents are shuffled once, by chunk, and every level
    reads that shuffle again. A task works on one chunk at a time, of ``chunk_rows`` rows and
    ``chunk_bytes`` bytes of text at most, or of one text.
    """
    spark = docs.sparkSession
    lengths = levels(window, first)
    place = ["chunk", "part"]
    rows, size = in_chunks(docs, chunk_ids, chunk_rows, chunk_bytes)
    # As many as the texts need, and two for each task at least, to even out what a task gets.
    buckets = max(2 * partitions(spark), size // BUCKET_BYTES)
    by_chunk = rows.repartition(partitions(spark), *place).groupBy(*place)
    answers = None
    for level in range(len(lengths)):
        if answers is None:
            asked = by_chunk.applyInArrow(asking(lengths, buckets), QUESTION)
        else:
            asked = by_chunk.cogroup(answers.groupBy(*place)).applyInArrow(
                asking_on(lengths, buckets, level), QUESTION
            )
        answers = asked.groupBy("bucket").applyInArrow(answering(lengths, level), ANSWER)

    def clean(key: tuple, texts: pa.Table, told: pa.Table) -> pa.Table:
        return cleaned(texts, told, lengths)

    return by_chunk.cogroup(answers.groupBy(*place)).applyInArrow(clean, RESULT)
