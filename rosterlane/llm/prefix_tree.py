"""Prefix tree of conversations, built from adaptive radix trees over fixed-width turn ids.

A turn's id is a number of 16 bytes, most significant first: the head of a digest of its role and text.
A conversation is the string of its turns' ids. Strings are cut into segments of ``SEGMENT`` turns, so
that a conversation of any length is many short rows; a segment hangs below the node in which the
conversation's earlier turns end. Equal segments at one node are one row with a count, however many
conversations share them. Sorted by (node, string), rows are cut into chunks, and each chunk becomes
one radix tree (``radix.py``), of which only the depths at whole turns are nodes.

Nodes on the first or last path of a chunk can occur in other chunks. All numbers are sums over
chunks, but for what depends on the node as a whole: that a text is saved for all but one of its
conversations, that a child is one child, that a leaf has no children. For the few nodes on the edges
this is put right by rows of differences for them and the nodes above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.llm.common import join_unique, kept_table
from rosterlane.llm.radix import Node, insert

ID_BYTES = 16
SEGMENT = 32
# Strings of one radix tree, and nodes handed on at once.
CHUNK = 8192
FLUSH = 50_000
# Rows of one window in a running aggregate over a key.
RUN = 1024
# Ids of conversations in one piece of a list to be hashed.
PIECE = 65_536

ROOT = bytes(ID_BYTES)
NODE_SCHEMA = (
    "start binary, node binary, parent binary, depth long, is_start boolean, edge boolean, goes_on boolean,"
    " n_convs long, first long, n_children long, n_leaves long, saved long, chars long, leaf long,"
    " above array<binary>"
)
NODE_COLUMNS = [c.split()[0] for c in NODE_SCHEMA.split(", ")]


@dataclass
class PrefixTree:
    """``nodes``: a row per distinct prefix. ``ends``: (node, conv_id) where each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


# ------------------------------------------------------------------------- turns in their order


def numbered(df: DataFrame, key: str, order: list[Column], name: str) -> DataFrame:
    """Add the place of each row among those of its key, from 0. No task gets a whole key.

    Rows are dealt by ranges of (key, order), equal rows by where they were read. Each range numbers its
    rows, and the ranges of one key are put behind one another. The rows of the ranges are written.
    """
    spread = df.withColumn("row", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(F.col(key), *order, F.col("row"))
    spread = kept_table(spread.withColumn("part", F.spark_partition_id()), "ordered")
    counts = spread.groupBy(key, "part").agg(F.count("*").alias("part rows"))
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("earlier", F.coalesce(F.sum("part rows").over(earlier), F.lit(0)))
    within = F.row_number().over(Window.partitionBy(key, "part").orderBy(*order, "row"))
    joined = spread.withColumn("within", within).join(counts.drop("part rows").hint("merge"), [key, "part"])
    return joined.withColumn(name, F.col("earlier") + F.col("within") - 1).drop("row", "part", "within", "earlier")


def turns(conversations: DataFrame) -> DataFrame:
    """(c, pos, id, chars): every turn of a conversation that has an id, in its order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    plain = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn"),
        F.unhex(F.substring(digest, 1, 2 * ID_BYTES)).alias("id"),
        F.length(text).cast("long").alias("chars"),
    )
    return numbered(plain, "c", [F.col("turn").asc_nulls_first(), F.col("id")], "pos").drop("turn")


def rebuilt(own: DataFrame, head: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """(c, total, pos, id, chars) of the rebuilt conversations, and (c, total) of all of them.

    A conversation takes its first turns from that of the family, ``c - c % family``: as many as the
    checksum of its id modulo ``head`` says, if there are so many, and goes on after as many of its own.
    """
    lengths = kept_table(own.groupBy("c").agg(F.count("*").alias("key_rows")), "conversations")
    rows = lengths.agg(F.sum("key_rows")).first()[0] or 0
    taken = F.crc32(F.col("c").cast("string").cast("binary")) % head
    convs = lengths.select("c", "key_rows", (F.col("c") - F.col("c") % family).alias("base"), taken.alias("taken"))
    bases = lengths.select(F.col("c").alias("base"), F.col("key_rows").alias("base_rows"))
    convs = convs.join(bases.hint("merge"), "base", "left").withColumn(
        "taken_rows", F.least("taken", F.coalesce("base_rows", F.lit(0)))
    )
    total = F.col("taken_rows") + F.greatest(F.col("key_rows") - F.col("taken"), F.lit(0))
    convs = kept_table(convs.withColumn("total", total).drop("base_rows"), "conversations")
    rest = join_unique(own, convs, "c", rows).where("pos >= taken").select(
        "c", "total", (F.col("pos") - F.col("taken") + F.col("taken_rows")).alias("pos"), "id", "chars"
    )
    heads = own.where(F.col("pos") < head).withColumnRenamed("c", "base")
    lent = convs.select("c", "total", "base", "taken_rows").where("taken_rows > 0")
    lent = lent.join(heads.hint("merge"), "base").where("pos < taken_rows").select("c", "total", "pos", "id", "chars")
    return rest.unionByName(lent), convs.select("c", "total")


# ------------------------------------------------------------------------------------ segments


def running(
    df: DataFrame, key: str, at: str, values: list[str], add: Callable, plus: Callable, falling: bool = False
) -> DataFrame:
    """Add ``run <value>``: the aggregate of the key's rows before each row in the order of ``at``.

    In two levels, over the rows of a run and over the runs, so that no window holds a whole key.
    """
    way = F.desc if falling else F.asc
    runs = df.withColumn("run", F.floor(F.col(at) / RUN))
    before = (Window.unboundedPreceding, -1)
    totals = runs.groupBy(key, "run").agg(*(add(v).alias(v) for v in values))
    over_runs = Window.partitionBy(key).orderBy(way("run")).rowsBetween(*before)
    totals = totals.select(key, "run", *(add(v).over(over_runs).alias(f"runs {v}") for v in values))
    inside = Window.partitionBy(key, "run").orderBy(way(at)).rowsBetween(*before)
    zero = F.lit(0).cast("long")
    near = runs.select("*", *(add(v).over(inside).alias(f"near {v}") for v in values))
    joined = near.join(totals.hint("merge"), [key, "run"])
    both = {f"run {v}": plus(F.coalesce(f"runs {v}", zero), F.coalesce(f"near {v}", zero)) for v in values}
    return joined.withColumns(both).drop("run", *(f"{w} {v}" for w in ("runs", "near") for v in values))


def two_longs(digest: Column) -> list[Column]:
    """A hexadecimal digest's first 128 bits as two longs."""
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17)]


def sixteen_bytes(high: str, low: str) -> Column:
    return F.unhex(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in (high, low))))


def segments(turn_rows: DataFrame) -> DataFrame:
    """(c, seg, start, string, chars, stop, last): a row per segment of a conversation.

    ``start`` is the node of the turns before, ``stop`` that of the turns up to the segment's end. The
    node of a whole number of segments is the exclusive or of their digests, so those of one long
    conversation are a running aggregate; a node inside a segment is the digest of ``start`` and the
    string up to there.
    """
    entry = F.struct("pos", "id", "chars")
    held = (
        turn_rows.groupBy("c", "total", F.floor(F.col("pos") / SEGMENT).alias("seg"))
        .agg(F.sort_array(F.collect_list(entry)).alias("turns"))
        .select(
            "c",
            "total",
            "seg",
            F.aggregate("turns", F.lit(b""), lambda s, t: F.concat(s, t["id"])).alias("string"),
            F.transform("turns", lambda t: t["chars"]).alias("chars"),
            F.size("turns").alias("n"),
        )
    )
    held = kept_table(held, "segments")
    single = held.where(F.col("total") <= SEGMENT).withColumns(
        {"run high": F.lit(0).cast("long"), "run low": F.lit(0).cast("long")}
    )
    several = held.where(F.col("total") > SEGMENT)

    def marked(df: DataFrame) -> DataFrame:
        mark = F.md5(F.concat(F.col("seg").cast("string").cast("binary"), F.lit(b":"), F.col("string")))
        return df.withColumns(dict(zip(("high", "low"), two_longs(mark))))

    def xor(one: Column, other: Column) -> Column:
        return one.bitwiseXOR(other)

    linked = running(marked(several), "c", "seg", ["high", "low"], F.bit_xor, xor)
    both = linked.unionByName(marked(single)).withColumns(
        {"stop high": xor(F.col("run high"), F.col("high")), "stop low": xor(F.col("run low"), F.col("low"))}
    )
    both = both.withColumn("start", sixteen_bytes("run high", "run low"))
    whole = sixteen_bytes("stop high", "stop low")
    inside = F.unhex(F.md5(F.concat("start", "string")))
    return both.select(
        "c",
        "seg",
        "start",
        "string",
        "chars",
        F.when(F.col("n") == SEGMENT, whole).otherwise(inside).alias("stop"),
        (F.col("total") == F.col("seg") * SEGMENT + F.col("n")).alias("last"),
        (F.col("total") > SEGMENT).alias("several"),
    )


# --------------------------------------------------------------------------------------- trees


def tree_nodes(seg: int, start: bytes, rows: list[tuple]) -> list[tuple]:
    """The nodes of one chunk: ``rows`` are (string, chars, stop, n, n_ending, first) in byte order."""
    root: Node | None = None
    for i, row in enumerate(rows):
        root = insert(root, row[0], i)
    out: list[tuple] = []
    final = len(rows) - 1

    def name(row: int, depth: int) -> bytes:
        if depth == 0:
            return start
        if depth == SEGMENT:
            return rows[row][2]
        return hashlib.md5(start + rows[row][0][: depth * ID_BYTES]).digest()

    def visit(node: Node, above: int, end: int) -> tuple:
        """What lies below ``above``: conversations, the first one, children, leaves, saved characters,
        first and last row. ``end``: the depth in bytes at which the node's path ends."""
        n, first, children, leaves, saved, low, high = 0, None, 0, 0, 0, final + 1, -1
        row = node.row
        if row >= 0:
            _, _, _, n, _, first = rows[row]
            low = high = row
        for child in node.children():
            a, b, c, d, e, f, g = visit(child, end, end + 1 + len(child.path))
            n, children, leaves, saved = n + a, children + c, leaves + d, saved + e
            first = b if first is None else min(first, b)
            low, high = min(low, f), max(high, g)
        for depth in range(end // ID_BYTES, above // ID_BYTES, -1):
            ending = row >= 0 and depth * ID_BYTES == end
            goes_on = ending and rows[row][4] < rows[row][3] and depth == SEGMENT
            leaf = int(ending and not children and not goes_on)
            chars = rows[low][1][depth - 1]
            leaves += leaf
            saved += (n - 1) * chars
            edge = low == 0 or high == final
            upper = [name(low, d) for d in range(depth)] if edge or goes_on else []
            out.append(
                (start, name(low, depth), name(low, depth - 1), seg * SEGMENT + depth, False, edge, goes_on)
                + (n, first, children, leaves, saved, chars, leaf, upper)
            )
            children = 1
        return n, first, children, leaves, saved, low, high

    n, first, children, leaves, saved, _, _ = visit(root, 0, len(root.path))
    out.append((start, start, None, seg * SEGMENT, True, False, False, n, first, children, leaves, saved, 0, 0, []))
    return out


def grown(rows: DataFrame, chunk: int) -> DataFrame:
    """The nodes of all chunks of the distinct segments, in the order of (seg, start, string)."""
    columns = ["string", "chars", "stop", "n", "n_ending", "first"]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: tuple | None = None
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            places = zip(batch["seg"].to_pylist(), batch["start"].to_pylist())
            for at, row in zip(places, zip(*(batch[c].to_pylist() for c in columns))):
                if held and (at != place or len(held) == chunk):
                    out += tree_nodes(*place, held)
                    held = []
                    if len(out) >= FLUSH:
                        yield batch_of(out)
                        out = []
                place = at
                held.append(row)
        if held:
            out += tree_nodes(*place, held)
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = {"binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary())}
        types = [kinds[c.split()[1]] for c in NODE_SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)], NODE_COLUMNS)

    order = ["seg", "start", "string"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(grow, NODE_SCHEMA)


def differences(found: DataFrame) -> DataFrame:
    """(start, node, target, n_children, n_leaves, saved): what edge nodes in several chunks add to the
    numbers of the nodes ``target`` above (and of their own)."""
    whole = (
        found.where("edge")
        .groupBy("start", "node", "parent")
        .agg(
            F.count("*").alias("times"),
            F.max("chars").alias("chars"),
            F.sum("n_children").alias("children"),
            F.sum("leaf").alias("leaf"),
            F.max("above").alias("above"),
        )
        .where("times > 1 or (leaf > 0 and children > 0)")
    )
    once = F.col("times") - 1
    zero = F.lit(0).cast("long")
    own = whole.select(
        "start", F.explode(F.array_append("above", F.col("node"))).alias("target"), zero.alias("n_children"),
        F.when(F.col("children") > 0, -F.col("leaf")).otherwise(zero).alias("n_leaves"),
        (once * F.col("chars")).alias("saved"),
    )
    parents = whole.select(
        "start", F.col("parent").alias("target"), (-once).alias("n_children"), zero.alias("n_leaves"), zero.alias("saved")
    )
    return own.unionByName(parents)


def beyond(parts: DataFrame, found: DataFrame, fixes: DataFrame, rows: int) -> DataFrame:
    """(node, n_leaves, saved): of nodes at the end of a whole segment, what lies in all segments below.

    The numbers of the segments at one node are given to the first conversation that goes there; summed
    from the end of every conversation, and over the conversations of a node, they count once each.
    """
    deep = "start <> unhex('{}')".format(ROOT.hex())
    held = found.where("is_start").where(deep).select("start", "n_leaves", "saved", "first", F.col("n_convs").alias("key_rows"))
    fixed = fixes.where("target = start").where(deep).select(
        "start", "n_leaves", "saved", F.lit(None).cast("long").alias("first"), F.lit(0).cast("long").alias("key_rows")
    )
    measures = [F.sum(c).alias(c) for c in ("n_leaves", "saved", "key_rows")]
    groups = held.unionByName(fixed).groupBy("start").agg(F.min("first").alias("first"), *measures)
    paths = parts.where("several").where(deep).select("c", "seg", "start")
    met = join_unique(paths, kept_table(groups, "groups"), "start", rows)
    owner = F.col("c") == F.col("first")
    own = met.select(
        "c", "seg", "start", *(F.when(owner, F.col(m)).otherwise(F.lit(0)).alias(m) for m in ("n_leaves", "saved"))
    )
    tails = running(own, "c", "seg", ["n_leaves", "saved"], F.sum, lambda a, b: a + b, falling=True)
    sums = [F.sum(F.col(f"run {m}") + F.col(m)).alias(m) for m in ("n_leaves", "saved")]
    return tails.groupBy(F.col("start").alias("node")).agg(*sums)


def prefix_tree(conversations: DataFrame, head: int = 6, family: int = 100, chunk: int = CHUNK) -> PrefixTree:
    """All prefixes of the rebuilt conversations (see ``rebuilt``), as nodes of a tree.

    ``nodes``: node, conv_id (the smallest conversation that starts with the prefix), depth in turns,
    parent, parent_conv_id, n_convs, n_children, n_leaves (nodes without children below it or itself)
    and saved_tokens (over it and all nodes below, the characters of the last text for every conversation
    but one). ``ends``: the node in which each conversation ends.

    Turns are ordered by ``turn``, null first, equal ones by the digest of role and text; repeated rows
    are turns of their own. A null role or text is empty. Rows without a conversation belong to none and
    are left out. Without conversations there are no nodes, without turns only the root. Other columns
    do not matter.
    """
    own = turns(conversations)
    turn_rows, convs = rebuilt(own, head, family)
    parts = kept_table(segments(turn_rows), "parts")
    same = parts.groupBy("seg", "start", "string", "chars", "stop").agg(
        F.count("*").alias("n"), F.sum(F.col("last").cast("long")).alias("n_ending"), F.min("c").alias("first")
    )
    found = kept_table(grown(kept_table(same, "distinct"), chunk), "nodes")
    fixes = kept_table(differences(found), "differences")
    below = kept_table(beyond(parts, found, fixes, parts.where("several").count()), "below")

    root = F.lit(ROOT)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    total = convs.agg(F.count("*").alias("n_convs"), F.min("c").alias("first"), F.max("total").alias("most"))
    base = total.where("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), "n_convs", "first",
        zero.alias("n_children"), F.when(F.col("most") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), zero.alias("saved"),
    )
    names = base.columns
    # The node a chunk starts at gets its children here; all else of it comes from where it ends.
    at_root = F.col("node") == root
    starts = found.where("is_start").select(
        "node", F.lit(None).cast("binary").alias("parent"), none.alias("depth"), zero.alias("n_convs"), none.alias("first"),
        "n_children", *(F.when(at_root, F.col(m)).otherwise(zero).alias(m) for m in ("n_leaves", "saved")),
    )
    inner = found.where("not is_start").select(*names)

    def added(df: DataFrame, node: Column, **measures: Column) -> DataFrame:
        values = {n: measures.get(n, none if n in ("depth", "first") else zero) for n in names}
        values |= {"node": node, "parent": F.lit(None).cast("binary")}
        return df.select(*(values[n].alias(n) for n in names))

    inside = (F.col("target") != F.col("start")) | (F.col("start") == root)
    put_right = added(
        fixes, F.col("target"), n_children=F.col("n_children"),
        n_leaves=F.when(inside, F.col("n_leaves")).otherwise(zero), saved=F.when(inside, F.col("saved")).otherwise(zero),
    )
    # What lies below a node counts for it and the nodes above it, up to where its own segment starts.
    carriers = found.where("goes_on").select("node", "above", "start")
    upper = F.filter("above", lambda a: (a != F.col("start")) | (a == root))
    carried = below.join(carriers.hint("merge"), "node").select(
        F.explode(F.array_append(upper, F.col("node"))).alias("target"), "n_leaves", "saved"
    )
    carried = added(carried, F.col("target"), n_leaves=F.col("n_leaves"), saved=F.col("saved"))

    everything = base
    for part in (starts, inner, put_right, carried):
        everything = everything.unionByName(part)
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    nodes = kept_table(
        everything.groupBy("node").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("first").alias("conv_id"), *sums
        ),
        "tree",
    )
    parents = nodes.where("n_children > 0").select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("key_rows")
    )
    known = join_unique(nodes.where("parent is not null"), parents, "parent", nodes.count())
    top = nodes.where("parent is null").withColumn("parent_conv_id", none)
    columns = ["node", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    named = known.select(*columns, "saved").unionByName(top.select(*columns, "saved"))
    ends = parts.where("last").select(F.col("stop").alias("node"), F.col("c").alias("conv_id"))
    turnless = convs.where("total = 0").select(root.alias("node"), F.col("c").alias("conv_id"))
    return PrefixTree(named.withColumnRenamed("saved", "saved_tokens"), ends.unionByName(turnless))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): of the ids of the conversations that end there, in order, comma-joined.

    The ids of a node are joined piece by piece, by as many tasks as they fill; the task that hashes
    reads its pieces as a stream.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def piece() -> tuple:
            return node, ids[0], ",".join(map(str, ids))

        for batch in batches:
            for at, c in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (at != node or len(ids) == PIECE):
                    out.append(piece())
                    ids = []
                node = at
                ids.append(c)
            if out:
                yield named(out, ["node", "first", "text"])
                out = []
        if ids:
            yield named([piece()], ["node", "first", "text"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for at, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist()):
                if at == node:
                    state.update(b"," + text.encode())
                    continue
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = at, hashlib.sha256(text.encode())
            if out:
                yield named(out, ["node", "ends_sha256"])
        if node is not None:
            yield named([(node, state.hexdigest())], ["node", "ends_sha256"])

    def named(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names)

    ranges = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ranges.mapInArrow(joined, "node binary, first long, text string")
    dealt = pieces.repartition("node").sortWithinPartitions("node", "first")
    return dealt.mapInArrow(hashed, "node binary, ends_sha256 string")
