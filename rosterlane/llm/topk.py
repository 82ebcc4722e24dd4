"""Exact search of the k highest inner products by vector-approximation files.

The file of approximations is written once: vectors in blocks of bounded size, each component as the
number of its cell, one of 2^bits equal parts of its column's range in the block. It holds a byte where a
vector holds eight, and it alone is scanned: the inner product of a query with the centres of a vector's
cells, and the vector's distance from them, bound the exact one from below and above. What the k-th best
lower bound of a query leaves are its candidates. Their exact vectors are then fetched by their row, in
the order of the upper bounds and in rounds, until the k-th exact score is above every bound that is left.

Of equal vectors only the first 2 k rows can be among the k best of any query, as ties go to smaller
ids and a query does not meet its own: the others are left out before the blocks are cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.llm.common import kept_table

# Rows of a block. A pair of blocks needs QUERY_BLOCK * VECTOR_BLOCK bounds of 4 or 8 bytes.
QUERY_BLOCK = 1024
VECTOR_BLOCK = 8192
# Of 64 random components, 4 bits leave 14 % of a block to be read, 6 bits 0.4 %, 8 bits 0.12 %.
BITS = 8
# Exact vectors that are read per query in the first round, in multiples of k; every round reads
# ROUND_GROWTH times as many as the one before.
FIRST_ROUND = 4
ROUND_GROWTH = 4
# Up to this length of vectors a block has its full number of rows.
FULL_DIMS = 1024


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): components as floor(scale * x). Rows whose vector is null, or holds a null or
    non-finite component, are left out; so are empty vectors and rows without an id."""
    value = F.col(f"`{vector}`")
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    kept = df.where(F.col(f"`{key}`").isNotNull() & value.isNotNull() & (F.size(value) > 0) & finite)
    return kept.select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.transform(value, lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("v"),
    )


def first_of_equal(rows: DataFrame, k: int) -> DataFrame:
    """The rows of every vector that can be among k results: without those of any one id, of which
    there may be k, at least k are left. Each task keeps as few before the shuffle."""
    by_id = Window.partitionBy("v", "id").orderBy("id")
    by_vector = Window.partitionBy("v").orderBy("id")
    once = rows.withColumn("copy", F.row_number().over(by_id)).where(F.col("copy") <= k).drop("copy")
    return once.withColumn("copy", F.row_number().over(by_vector)).where(F.col("copy") <= 2 * k).drop("copy")


# ------------------------------------------------------------------------- approximation files


def quantised(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cells, low, width, error): the cell of every component; per column the lower edge and width of
    a cell; per vector its distance from the centres of its cells."""
    exact = vectors.astype(float)
    low, high = exact.min(axis=0), exact.max(axis=0)
    width = np.maximum((high - low) / (1 << bits), 1e-9)
    cells = np.clip(np.floor((exact - low) / width), 0, (1 << bits) - 1).astype(np.uint8)
    away = exact - (low + (cells + 0.5) * width)
    most = np.abs(away).max(initial=1e-300)
    return cells, low, width, most * np.sqrt(((away / most) ** 2).sum(axis=1))


def packed_bits(cells: np.ndarray, bits: int) -> bytes:
    """Cells one behind the other, ``bits`` bits each."""
    return np.packbits(np.unpackbits(cells.reshape(-1, 1), axis=1)[:, 8 - bits :]).tobytes()


def unpacked_bits(data: bytes, rows: int, dims: int, bits: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=rows * dims * bits).reshape(-1, bits)
    weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
    return (flat * weights).sum(axis=1, dtype=np.uint8).reshape(rows, dims)


def blocks_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, np.ndarray]]:
    """(dims, columns other than the vector, vectors) of at most ``size`` rows, fewer of long vectors;
    vectors of other lengths go to other blocks. At most two blocks' components wait."""
    held: dict[int, list[tuple]] = {}
    most = size * FULL_DIMS
    waiting = 0

    def block(dims: int) -> tuple[int, list, np.ndarray]:
        rows = held.pop(dims)
        return dims, list(zip(*(r[:-1] for r in rows))), np.stack([r[-1] for r in rows])

    for batch in batches:
        vectors = batch["v"]
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        edges = np.cumsum([0, *vectors.value_lengths().to_pylist()])
        others = zip(*(batch[c].to_pylist() for c in batch.schema.names if c != "v"))
        for i, other in enumerate(others):
            dims = int(edges[i + 1] - edges[i])
            rows = held.setdefault(dims, [])
            rows.append((*other, flat[edges[i] : edges[i + 1]]))
            waiting += dims
            if len(rows) == size or len(rows) * dims >= most:
                waiting -= len(rows) * dims
                yield block(dims)
            elif waiting > 2 * most:
                waiting = 0
                for other_dims in list(held):
                    yield block(other_dims)
    for dims in list(held):
        yield block(dims)


def in_a_row(blocks: DataFrame, name: str) -> DataFrame:
    """Number the blocks of a written table from 0. Only their ids meet in one task: a row per block."""
    ids = blocks.select("block id").withColumn(name, F.row_number().over(Window.orderBy("block id")) - 1)
    return blocks.join(ids.hint("merge"), "block id").drop("block id")


def every(blocks: DataFrame, other: str, count: int) -> DataFrame:
    """Each block once for every block of the other kind."""
    return blocks.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


APPROXIMATIONS = "dims int, ids array<long>, rows array<long>, low array<double>, width array<double>, error array<double>, cells binary"


def approximations(exact: DataFrame, size: int, bits: int) -> DataFrame:
    """The file of approximations of (row, id, v): a row per block."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, (rows, ids), vectors in blocks_of(batches, size):
            cells, low, width, error = quantised(vectors, bits)
            values = [dims, list(ids), list(rows), low.tolist(), width.tolist(), error.tolist(), packed_bits(cells, bits)]
            longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
            kinds = [pa.int32(), longs, longs, doubles, doubles, doubles, pa.binary()]
            arrays = [pa.array([v], t) for v, t in zip(values, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in APPROXIMATIONS.split(", ")])

    return exact.select("row", "id", "v").mapInArrow(write, APPROXIMATIONS)


def query_blocks(asked: DataFrame, size: int) -> DataFrame:
    """(dims, queries, query_ids, vectors): queries (query, id, v) in blocks; vectors end to end."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dims, (queries, ids), vectors in blocks_of(batches, size):
            values = [[dims], [list(queries)], [list(ids)], [vectors.ravel()]]
            longs = pa.list_(pa.int64())
            arrays = [pa.array(v, t) for v, t in zip(values, [pa.int32(), longs, longs, longs])]
            yield pa.RecordBatch.from_arrays(arrays, ["dims", "queries", "query_ids", "vectors"])

    schema = "dims int, queries array<long>, query_ids array<long>, vectors array<long>"
    return asked.select("query", "id", "v").mapInArrow(write, schema)


# -------------------------------------------------------------------------------------- search


def bounds(
    queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray, error: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(below, above): bounds of the inner products of queries and vectors.

    An inner product differs from that with the centres by at most the query's length times the
    vector's distance from them, and by what rounding can add.
    """
    wanted = queries.astype(float)
    scaled = wanted * width
    top = int(cells.max(initial=0))
    reach = np.abs(wanted) @ np.maximum(np.abs(low), np.abs(low + width * (top + 1)))
    # Single precision will do where nothing overflows: what it loses is part of the bounds.
    kind = np.float32 if reach.max(initial=0) < 1e30 else np.float64
    about = (scaled.astype(kind) @ cells.astype(kind).T).astype(np.float64)
    about += (wanted @ (low + width / 2))[:, None]
    steps = 4 * (queries.shape[1] + 4)
    rounding = steps * (np.finfo(kind).eps * top * np.abs(scaled).sum(axis=1) + np.finfo(float).eps * reach) + 1.0
    most = np.abs(wanted).max(axis=1, initial=1e-300)
    length = most * np.sqrt(((wanted / most[:, None]) ** 2).sum(axis=1))
    slack = (length * (1 + 1e-9))[:, None] * error[None, :] + rounding[:, None]
    return about - slack, about + slack


def candidates(
    query_ids: np.ndarray, ids: np.ndarray, below: np.ndarray, above: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) places that the bounds of this block leave: below the k-th best lower bound
    nothing can be among the k best. A query does not meet its own id."""
    own = query_ids[:, None] == ids[None, :]
    below[own] = above[own] = -np.inf
    floor = np.full(len(below), -np.inf)
    if below.shape[1] > k:
        floor = np.partition(below, -k, axis=1)[:, -k]
    return np.nonzero((above >= floor[:, None]) & (above > -np.inf))


def scanned(pairs: DataFrame, k: int, bits: int) -> DataFrame:
    """(query, row, below, above): candidates of all pairs of blocks with their bounds."""

    def numbers(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
        return batch[name][i].values.to_numpy(zero_copy_only=False)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, query_ids = numbers(batch, "ids", i), numbers(batch, "query_ids", i)
                dims = batch["dims"][i].as_py()
                wanted = numbers(batch, "vectors", i).reshape(-1, dims)
                cells = unpacked_bits(batch["cells"][i].as_buffer(), len(ids), dims, bits)
                ranges = (numbers(batch, c, i) for c in ("low", "width", "error"))
                below, above = bounds(wanted, cells, *ranges)
                query, vector = candidates(query_ids, ids, below, above, k)
                arrays = [
                    numbers(batch, "queries", i)[query],
                    numbers(batch, "rows", i)[vector],
                    below[query, vector],
                    above[query, vector],
                ]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["query", "row", "below", "above"])

    return pairs.mapInArrow(scan, "query long, row long, below double, above double")


def scored(met: DataFrame) -> DataFrame:
    """(query, query_id, vec_id, score): exact inner products of (v, w). Integers that wrap around give
    the right sum wherever it is a long; a score that is none raises."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("v", "w"))
            ends = np.cumsum(batch["v"].value_lengths().to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            with np.errstate(over="ignore"):
                exact = np.add.reduceat(one * other, starts) if len(starts) else np.empty(0, np.int64)
            about = np.add.reduceat(one.astype(float) * other, starts) if len(starts) else exact
            if (np.abs(about) >= 2.0**63 * (1 - 1e-12)).any():
                raise ValueError("a score does not fit a long")
            arrays = [*(batch[c] for c in ("query", "query_id", "vec_id")), pa.array(exact)]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "vec_id", "score"])

    return met.mapInArrow(score, "query long, query_id long, vec_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def exact_top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    bits: int = BITS,
    vector_block: int = VECTOR_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): per query its k highest inner products with other rows.

    Components count as floor(scale * x), scores are exact; one that is no long raises. Ties go to the
    smaller id; fewer than k other rows give fewer results. A query never meets rows of its own id.
    Repeated ids are searched as the rows they are, queries as one row per id and vector, each with its
    own ranks. Vectors meet only others of the same length; rows without an id or with a null or
    non-finite component take no part, an empty table gives no rows, other columns do not matter.

    Every block of queries meets every block of approximations; exact vectors only their candidates.
    """
    rows = whole_vectors(df, key, vector, scale)
    asked = whole_vectors(df.where(is_query), key, vector, scale).distinct()
    number = F.monotonically_increasing_id()
    exact = kept_table(first_of_equal(rows, k).withColumn("row", number), "vectors")
    queries = kept_table(asked.withColumn("query", number), "queries")
    if queries.isEmpty():
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cells = kept_table(approximations(exact, vector_block, bits).withColumn("block id", number), "cells")
    wanted = kept_table(query_blocks(queries, query_block).withColumn("block id", number), "query-blocks")
    n_cells, n_wanted = cells.count(), wanted.count()
    # Both sides name the pair, so that no two pairs have to share a task. Nothing is broadcast: the
    # optimizer takes repeated blocks for as small as single ones.
    met = every(in_a_row(cells, "block"), "query_block", n_wanted).hint("merge").join(
        every(in_a_row(wanted, "query_block"), "block", n_cells).hint("merge"), ["dims", "block", "query_block"]
    )
    near = kept_table(scanned(met, k, bits), "near")

    # Of all blocks together, and in the order of the bounds.
    by_low = Window.partitionBy("query").orderBy(F.desc("below"))
    lowest = near.withColumn("n", F.row_number().over(by_low)).where(F.col("n") <= k)
    floor = lowest.groupBy("query").agg(F.min("below").alias("floor"), F.max("n").alias("n"))
    left = near.join(floor.hint("merge"), "query").where((F.col("above") >= F.col("floor")) | (F.col("n") < k))
    left = kept_table(left.select("query", "row", "above"), "candidates")
    of_query = queries.select("query", F.col("id").alias("query_id"), F.col("v").alias("w"))
    of_row = exact.select("row", F.col("id").alias("vec_id"), "v")
    best, step = None, FIRST_ROUND * k
    by_bound = Window.partitionBy("query").orderBy(F.desc("above"), "row")
    while True:
        ordered = left.withColumn("n", F.row_number().over(by_bound))
        ordered = kept_table(ordered, "ordered")
        read = ordered.where(F.col("n") <= step).select("query", "row")
        read = read.join(of_query.hint("merge"), "query").join(of_row.hint("merge"), "row")
        found = scored(read.select("query", "query_id", "vec_id", "v", "w"))
        found = found if best is None else best.select(*found.columns).unionByName(found)
        best = kept_table(best_of(found, k), "best")
        kth = best.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
        left = ordered.where(F.col("n") > step).join(kth.hint("merge"), "query", "left")
        # Bounds leave room for more than what a score loses when it is compared as a double.
        left = left.where(F.col("kth").isNull() | (F.col("above") >= F.col("kth").cast("double")))
        left = left.select("query", "row", "above")
        if left.isEmpty():
            return best.select("query_id", "rank", "vec_id", "score")
        step *= ROUND_GROWTH
