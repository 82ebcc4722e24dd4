"""Near duplicates by SimHash, found through deletion variants.

A text's fingerprint has 64 bits; texts are near when few bits differ. The bits are cut into the
fewest segments of which one must differ in at most one bit (three for four bits). Every segment is
indexed once per wildcard, with that one bit left out: fingerprints that agree in a segment but for
one bit share the variant that leaves it out. So that few unrelated fingerprints meet, the key also
holds a piece of the other bits: they are cut so that one piece must be equal. An equality join on
the variants finds all candidates, and the whole distance is verified in the join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.llm.common import fresh, join_unique, kept_table, partitions
from rosterlane.llm.components import components

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
SLICE = 1 << 16


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number.

    Words are cut at ASCII white space, A-Z lower-cased. Each shingle of ``size`` words, repeats
    included, votes with the bits of its XXH64; a bit is set where over half of them have it. Fewer
    words are one shingle; no words give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        spans = zip(starts[at : at + SLICE].tolist(), ends[at : at + SLICE].tolist(), strict=True)
        codes = np.array([digest(joined[i:j], SEED) for i, j in spans], "<u8")
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * votes > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; a null text counts as empty."""
    schema = "doc_id long, text_hash long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].cast(pa.large_binary())
            fps = [fingerprint(value.as_py(), size) for value in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(fps, pa.int64())],
                ["doc_id", "text_hash", "fp"],
            )

    body = F.coalesce("text", F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("long"), body)
    return rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one differs in at most one bit."""
    parts = distance // 2 + 1
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def cut_mask(bits: Sequence[int], parts: int) -> list[int]:
    """The bits in ``parts`` masks of about equal width; one empty mask if there are too few bits."""
    if len(bits) < parts:
        return [0]
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << bit for bit in bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


@dataclass(frozen=True)
class Scheme:
    """The pairs whose first near segment is ``segment`` (a mask), where they differ in exactly the
    wildcard bit or, without ``wildcards``, not at all. One of ``pieces`` (masks) is equal then."""

    segment: int
    wildcards: tuple[int, ...]
    pieces: tuple[int, ...]
    earlier: tuple[int, ...]


def schemes(distance: int) -> list[Scheme]:
    """All ways in which a pair within ``distance`` bits can be found, each pair by one of them.

    Segments before the first near one differ in two bits or more. What is left of the distance
    goes to the others: cut into one piece more than that, one piece has to be equal. Of all other
    segments and the later ones alone, those that make wider pieces are cut.
    """
    cuts = [range(first, first + bits) for first, bits in segments(distance)]
    masks = [sum(1 << bit for bit in cut) for cut in cuts]
    found = []
    for k, cut in enumerate(cuts):
        for differing in (0, 1):
            left = distance - differing - 2 * k
            if left < 0:
                continue
            later = [bit for other in cuts[k + 1 :] for bit in other]
            others = [bit for other in cuts[:k] for bit in other] + later
            ways = [cut_mask(others, left + 2 * k + 1), cut_mask(later, left + 1)]
            pieces = max(ways, key=lambda way: min(mask.bit_count() for mask in way))
            wildcards = tuple(cut) if differing else ()
            found.append(Scheme(masks[k], wildcards, tuple(pieces), tuple(masks[:k])))
    return found


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: every pair of distinct fingerprints (column fp) within ``distance`` bits, once.

    The key of a variant is its segment without the wildcard bit, and one piece of the other bits. A
    pair may share many keys; it counts only in the first segment that is near, at the bit that
    differs there, and in the first piece that is equal. Keys of a single fingerprint leave before
    the join, so the index is shuffled once.
    """
    ways = schemes(distance)
    variants, tests = [], []
    difference = "(x.fp ^ y.fp)"

    def differing(mask: int) -> str:
        return f"({difference} & {signed(mask)}L)"

    def named(scheme: int, wildcard: int, piece: int) -> int:
        return (piece * BITS + wildcard) * len(ways) + scheme

    for number, way in enumerate(ways):
        for piece, also in enumerate(way.pieces):
            for wildcard in way.wildcards or (None,):
                kept = way.segment | also
                if wildcard is not None:
                    kept &= ~(1 << wildcard)
                variants.append((named(number, wildcard or 0, piece), signed(kept)))
        wildcard = f"shiftleft(1L, x.variant div {len(ways)} % {BITS})" if way.wildcards else "0L"
        first = " ".join(
            f"when {differing(mask)} = 0 then {piece}" for piece, mask in enumerate(way.pieces)
        )
        test = [
            f"x.variant % {len(ways)} = {number}",
            f"{differing(way.segment)} = {wildcard}",
            f"x.variant div {BITS * len(ways)} = case {first} end",
            *(f"bit_count({differing(mask)}) > 1" for mask in way.earlier),
        ]
        tests.append(f"({' and '.join(test)})")
    # The masks are a constant: as expressions of their own they would be too much code to compile.
    masks = ", ".join(f"struct({name} as variant, {mask}L as mask)" for name, mask in variants)
    # Every row becomes many: dealt over all tasks first, as few files hold the fingerprints.
    dealt = prints.select("fp").repartition(partitions(prints.sparkSession), "fp")
    indexed = dealt.selectExpr("fp", f"inline(array({masks}))")
    indexed = indexed.selectExpr("fp", "variant", "fp & mask as rest")
    near = F.expr(
        "x.variant = y.variant and x.rest = y.rest and x.fp < y.fp and"
        f" bit_count({difference}) <= {distance} and ({' or '.join(tests)})"
    )
    # Most keys have one fingerprint; the others are written, so that both sides read them.
    alike = Window.partitionBy("variant", "rest")
    met = indexed.withColumn("prints", F.count("*").over(alike)).where("prints > 1").drop("prints")
    shared = kept_table(met, "shared-variants")
    one, other = shared.alias("x").hint("merge"), shared.alias("y").hint("merge")
    return one.join(other, near).selectExpr("x.fp as a", "y.fp as b")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row: the smallest fingerprint (as a
    signed number) and the smallest doc_id that can be reached over fingerprints at most
    ``distance`` bits apart, itself included.

    Texts without words (null, empty, blank) share the fingerprint 0. Rows without an id take part
    and give no id; a component of such rows alone has none. Equal fingerprints are looked at once,
    however many rows have them, and only fingerprints that have links are part of the rounds.
    """
    prints = kept_table(fingerprints(docs, size), "fingerprints")
    distinct = prints.groupBy("fp").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("key_rows")
    )
    distinct = kept_table(distinct, "distinct-fingerprints")
    rooted = kept_table(components(links(distinct, distance)), "components")
    joined = distinct.join(rooted, distinct["fp"] == rooted["node"], "left")
    grouped = joined.where("root is not null").select(
        "fp", "first_id", F.col("key_rows").alias("prints"), "root"
    )
    of_root = grouped.groupBy("root").agg(
        F.min("first_id").alias("component_id"), F.count("*").alias("key_rows")
    )
    linked = join_unique(grouped, of_root, "root", rooted.count()).select(
        "fp", "root", "component_id", F.col("prints").alias("key_rows")
    )
    alone = joined.where("root is null").select(
        "fp", F.col("fp").alias("root"), F.col("first_id").alias("component_id"), "key_rows"
    )
    of_print = kept_table(linked.unionByName(alone), "component-of-fingerprint")
    return join_unique(prints, of_print, "fp", prints.count()).select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def hex_print(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_group(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The documents with one row of each component: of its smallest id, among rows of that id the
    one of the smallest text hash, and one of equal rows. All columns stay as they are."""
    found = near_duplicates(docs, size, distance)
    kept_id, kept_hash, text_hash, place = fresh(docs, "kept id", "kept hash", "text hash", "place")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = (
        first.groupBy("root")
        .agg(F.min("component_id").alias(kept_id), F.min("text_hash").alias(kept_hash))
        .drop("root")
    )
    marked = docs.withColumn(text_hash, F.xxhash64(F.coalesce("text", F.lit(""))))
    same_id = F.col("doc_id").eqNullSafe(F.col(f"`{kept_id}`"))
    joined = marked.join(chosen, same_id & (F.col(f"`{text_hash}`") == F.col(f"`{kept_hash}`")))
    # Equal rows of the chosen id and text meet here, and nothing else.
    same = Window.partitionBy(kept_id, kept_hash).orderBy(kept_hash)
    kept = joined.withColumn(place, F.row_number().over(same)).where(F.col(place) == 1)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))
