import numpy as np
import pytest
import xxhash
from helpers_llm import ordered, words
from pyspark.sql import functions as F
from rosterlane.llm import components, simhash


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_fingerprint(text, size=4):
    found = [w.encode() for w in words(lowered(text))]
    if not found:
        return 0
    shingles = [b" ".join(found[i : i + size]) for i in range(len(found) - size + 1)]
    codes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles or [b" ".join(found)]]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def brute(rows, distance):
    prints = [plain_fingerprint(t) for _, t in rows]
    distinct = np.array(sorted(set(prints)), np.uint64)
    parent = {int(p): int(p) for p in distinct}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(distinct):
        for other in distinct[i + 1 :][np.bitwise_count(distinct[i + 1 :] ^ p) <= distance]:
            parent[find(int(other))] = find(int(p))
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[find(p)] = min(least.get(find(p), doc_id), doc_id)
    return ordered((d, f"{p:016x}", least.get(find(p))) for (d, _), p in zip(rows, prints))


def got(df, distance):
    found = simhash.near_duplicates(df, distance=distance)
    return ordered(found.select("doc_id", simhash.hex_print(F.col("fp")), "component_id").collect())


@pytest.mark.parametrize("distance", [4, 7])
def test_equals_brute_force(documents, distance):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert got(documents, distance) == brute(rows, distance)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert got(odd, 4) == brute(rows, 4)
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns
    groups = {c for _, _, c in brute(rows, 4)}
    assert ordered(kept.select("doc_id").collect()) == ordered((c,) for c in groups)
    assert kept.where("doc_id = 4").count() == 1


def test_empty_table(odd):
    nothing = odd.where("doc_id > 100")
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.one_per_group(nothing).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 4, 5, 8])
def test_every_pair_within_the_distance_is_linked_once(spark, distance):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    prints = set()
    for p in base.tolist():
        for _ in range(12):
            flips = rng.choice(64, rng.integers(0, distance + 3), replace=False)
            prints.add(p ^ sum(1 << int(b) for b in flips))
    prints = sorted(prints)
    want = {
        frozenset((a, b))
        for i, a in enumerate(prints)
        for b in prints[i + 1 :]
        if (a ^ b).bit_count() <= distance
    }
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    rows = simhash.links(frame, distance).collect()
    found = [frozenset((r["a"] % 2**64, r["b"] % 2**64)) for r in rows]
    assert len(found) == len(set(found)) and set(found) == want


def test_the_index_is_never_broadcast(spark):
    df = simhash.links(spark.range(100).selectExpr("id as fp"))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin" in final and "Broadcast" not in final


def test_keys_are_wide_and_pieces_suffice():
    ways = simhash.schemes(4)
    assert sum(len(way.pieces) * max(1, len(way.wildcards)) for way in ways) == 141
    for way in ways:
        bits = way.segment.bit_count() - bool(way.wildcards)
        assert min(bits + piece.bit_count() for piece in way.pieces) >= 29
        assert all(piece & way.segment == 0 for piece in way.pieces)
        assert sum(piece.bit_count() for piece in way.pieces) == sum(way.pieces).bit_count()


def test_segments():
    assert simhash.segments(4) == [(0, 21), (21, 21), (42, 22)]
    assert len(simhash.segments(3)) == 2


def test_components_of_chains_stars_and_cycles(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 100 + i) for i in range(1, 40)]
    cycle = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    links = spark.createDataFrame(chain + star + cycle + [(5, 5), (1, 0)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components.components(links).collect()}
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)} | {200 + i: 200 for i in range(9)}
    assert roots == want
    assert components.components(links.where("a > 1000")).count() == 0
