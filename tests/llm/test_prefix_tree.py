import hashlib
import zlib
from collections import defaultdict

import pytest
from helpers_llm import FOLDER, ordered
from hypothesis import given, settings
from hypothesis import strategies as st
from rosterlane.llm import prefix_tree, queries, radix


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def plain_tree(rows, head=6, family=100):
    """Every prefix of every rebuilt conversation in a dictionary."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, digest(role or "", text or ""), len(text or "")))
    convs = {c: [(i, n) for _, _, i, n in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % head
        # The quotient is cut towards zero.
        built[c] = convs.get(int(c / family) * family, [])[:h] + own[h:]
    members, chars, ends, children = defaultdict(list), {}, defaultdict(list), defaultdict(set)
    for c, seq in built.items():
        names = [()]
        for i, n in seq:
            names.append((names[-1], i))
            children[names[-2]].add(names[-1])
            chars[names[-1]] = n
        for depth, name in enumerate(names):
            members[name, depth].append(c)
        ends[names[-1]].append(c)
    saved, leaves = defaultdict(int), defaultdict(int)
    for (name, _), cs in members.items():
        gain, leaf, at = (len(cs) - 1) * chars.get(name, 0), int(not children[name]), name
        while True:
            saved[at] += gain
            leaves[at] += leaf
            if at == ():
                break
            at = at[0]
    first = {name: min(cs) for (name, _), cs in members.items()}
    return ordered(
        (
            first[name], depth, first[name[0]] if name else None, len(cs), len(children[name]), leaves[name], saved[name],
            hashlib.sha256(",".join(map(str, sorted(ends[name]))).encode()).hexdigest(),
        )
        for (name, depth), cs in members.items()
    )


def query_rows(tree):
    ended = prefix_tree.end_digests(tree.ends)
    found = tree.nodes.join(ended, "node", "left").fillna(hashlib.sha256(b"").hexdigest(), subset=["ends_sha256"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return ordered(found.select(*columns).collect())


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def odd_conversations(spark):
    """Copies, prefixes of others, null and repeated turns, lengths at the edges of segments, chains
    that part deep down, families without a first conversation, negative ids, clashing columns."""
    rows = []
    for c in [*range(0, 40), *range(100, 130), 250, 251, -5, -101, 777]:
        n = c % 9 if c >= 0 else 3
        rows += [(c, i, "user" if i % 2 else None, f"t{(c % 3) * (i > 4)}-{i}") for i in range(n)]
        rows.append((c, 100, "user", None if c % 4 else "last"))
    for c, n in ((300, 32), (301, 33), (302, 64), (303, 65), (304, 200), (305, 200), (306, 96), (400, 64), (401, 64)):
        rows += [(c, i, "user", "same" if i < 150 else f"{c}") for i in range(n)]
    rows += [(500 + k, i, "user", f"w{i}") for k in range(20) for i in range(70 - k % 2)]
    rows += [(600, None, "a", "x"), (600, None, "a", "x"), (600, 3, None, "é😀"), (600, 3, "b", "y"), (600, -1, "", "")]
    rows += [(None, 1, "user", "none"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.selectExpr("*", "1 as node", "'x' as id", "2 as c", "3 as first")


@pytest.mark.parametrize("chunk", [prefix_tree.CHUNK, 1, 3])
def test_tree_equals_brute_force(spark, odd_conversations, chunk):
    rows = odd_conversations.select("conv_id", "turn", "role", "text").collect()
    tree = prefix_tree.prefix_tree(odd_conversations, chunk=chunk)
    assert query_rows(tree) == plain_tree([tuple(r) for r in rows])


def test_long_runs(spark, odd_conversations, monkeypatch):
    """The running aggregates over segments and the lists to be hashed are cut into parts."""
    monkeypatch.setattr(prefix_tree, "RUN", 2)
    monkeypatch.setattr(prefix_tree, "PIECE", 3)
    rows = odd_conversations.select("conv_id", "turn", "role", "text").collect()
    tree = prefix_tree.prefix_tree(odd_conversations)
    assert query_rows(tree) == plain_tree([tuple(r) for r in rows])


def test_empty_and_turnless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert query_rows(prefix_tree.prefix_tree(empty)) == []
    # None of the conversation's own turns is behind those it takes from a family that is not there.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    rows = [(c, 0, "user", "x")]
    tree = prefix_tree.prefix_tree(spark.createDataFrame(rows, SCHEMA))
    assert query_rows(tree) == plain_tree(rows)
    assert len(plain_tree(rows)) == 1


def test_query_on_all_conversations(spark, documents):
    rows = spark.read.parquet(str(FOLDER / "conversations.parquet"))
    found = queries.QUERIES["op11_prefix_tree"](spark, str(FOLDER))
    assert ordered(found.collect()) == plain_tree([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


@settings(max_examples=100, deadline=None)
@given(st.sets(st.binary(max_size=4), max_size=60))
def test_radix_tree_holds_its_strings_in_order(keys):
    root = None
    for i, key in enumerate(sorted(keys, key=lambda k: k[::-1])):
        root = radix.insert(root, key, i)
    rows = {i: key for i, key in enumerate(sorted(keys, key=lambda k: k[::-1]))}

    def walk(node, prefix):
        here = prefix + node.path
        if node.row >= 0:
            yield here, node.row
        for byte, child in node.layout.items() if node.layout else ():
            yield from walk(child, here + bytes([byte]))

    found = list(walk(root, b"")) if root else []
    assert [k for k, _ in found] == sorted(keys)
    assert all(rows[row] == k for k, row in found)


def test_layouts_grow():
    node, kinds = radix.Node(b""), []
    for byte in range(255, -1, -1):
        node.put(byte, radix.Node(bytes([byte])))
        kinds.append((type(node.layout).__name__, getattr(node.layout, "room", 0)))
    assert [kinds[i] for i in (3, 4, 15, 16, 47, 48, 255)] == [
        ("Sorted", 4), ("Sorted", 16), ("Sorted", 16), ("Indexed", 0), ("Indexed", 0), ("Direct", 0), ("Direct", 0)
    ]
    assert [c.path[0] for c in node.children()] == list(range(256))
    assert node.layout.get(7).path == b"\x07"


def test_compressed_paths_give_every_depth():
    """One conversation is one radix node, and as many nodes of the result as it has turns."""
    string = b"".join(i.to_bytes(16) for i in range(10))
    assert radix.insert(None, string, 0).layout is None
    found = prefix_tree.tree_nodes(0, prefix_tree.ROOT, [(string, list(range(10)), b"", 4, 4, 9)])
    assert sorted(r[3] for r in found) == list(range(11))
