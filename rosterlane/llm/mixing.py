"""Mixing sources to target weights.

Temperature mixing: a source's weight is its share of the tokens, raised to an exponent between 0
and 1 and made to sum to 1. The exponent is found by bisection, so that the weights have a target
entropy, or that no source is repeated more than a limit. A stream with these weights is then laid
out: in every pass over a source its blocks of documents are permuted anew, and the last pass stops
when the source's token budget is used up.

Sources may be many: their totals stay a table, and the bisection only asks it for sums. Permutations
are orders of digests of what a document is, so the same documents give the same stream everywhere.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterlane.llm.common import fresh, join_unique, kept_table, sum_before

# A block has about as many tokens, and no more than about so many documents.
BLOCK_TOKENS = 50_000
BLOCK_ROWS = 5_000
# Blocks of one pass that are added up together.
RUN_BLOCKS = 1024
# The bisection halves the interval of the exponent this often, SECTIONS-fold with every look.
HALVINGS = 42
SECTIONS = 64


def token_count(text: Column) -> Column:
    """Words of a text, as tokens are not at hand; a null or blank text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


# ----------------------------------------------------------------------------------- exponent


@dataclass
class Shares:
    """The shares of the sources that have tokens: the least and the greatest, and for exponents a the
    sums of s^a and of s^a log2 s."""

    least: float
    most: float
    moments: Callable[[list[float]], list[tuple[float, float]]]

    @classmethod
    def of(cls, shares: Mapping) -> Shares | None:
        known = [s for s in shares.values() if s > 0]

        def moments(exponents: list[float]) -> list[tuple[float, float]]:
            return [
                (math.fsum(s**a for s in known), math.fsum(s**a * math.log2(s) for s in known)) for a in exponents
            ]

        return cls(min(known), max(known), moments) if known else None

    @classmethod
    def of_table(cls, totals: DataFrame) -> Shares | None:
        """Of (source, total): what comes to the driver is a row per exponent."""
        row = totals.where("total > 0").agg(F.sum("total"), F.min("total"), F.max("total")).first()
        if row[0] is None:
            return None
        share = F.col("total") / F.lit(row[0])

        def moments(exponents: list[float]) -> list[tuple[float, float]]:
            tried = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(a).alias("a")) for i, a in enumerate(exponents))))
            raised = totals.where("total > 0").select(share.alias("s"), tried.alias("e"))
            raised = raised.select("e.i", "s", F.pow("s", "e.a").alias("r"))
            sums = raised.groupBy("i").agg(F.sum("r").alias("z"), F.sum(F.col("r") * F.log2("s")).alias("l"))
            found = {r["i"]: (r["z"], r["l"]) for r in sums.collect()}
            return [found[i] for i in range(len(exponents))]

        return cls(row[1] / row[0], row[2] / row[0], moments)

    def entropy(self, exponent: float, z: float, l: float) -> float:
        """Shannon entropy of the weights, in bits."""
        return math.log2(z) - exponent * l / z

    def repeats(self, exponent: float, z: float, budget: float | None) -> float:
        """How often the most repeated source is read. ``budget``: stream length in lengths of the whole
        data; None: the shortest stream that cuts no source."""
        if budget is None:
            return (self.least / self.most) ** (exponent - 1)
        return budget * self.least ** (exponent - 1) / z


def weights(shares: Mapping, exponent: float) -> dict:
    """Shares raised to the exponent, made to sum to 1; a source without tokens has weight 0."""
    raised = {k: s**exponent if s > 0 else 0.0 for k, s in shares.items()}
    total = math.fsum(raised.values())
    return {k: r / total if total else 0.0 for k, r in raised.items()}


def solve_exponent(
    shares: Mapping | Shares | None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = 1.0,
    evenness: float | None = None,
) -> float:
    """The lowest exponent in [0, 1] that keeps to the limits, by bisection.

    Entropy falls and repetition falls as the exponent grows. ``target_entropy``: the exponent at
    which the weights have that entropy (0 or 1 where it is out of reach). ``evenness``: the same, with
    the target so far between the entropy of the shares (0) and that of equal weights (1).
    ``max_repeats``: the lowest exponent at which no source is read more often. With several, the
    largest exponent. Without a target there is no temperature: 1.
    """
    table = Shares.of(shares) if isinstance(shares, Mapping) else shares
    if target_entropy is None and max_repeats is None and evenness is None:
        return 1.0
    if table is None:
        return 0.0

    def bisect(too_low: Callable[[float, float, float], bool]) -> float:
        low, high = 0.0, 1.0
        if not too_low(0.0, *table.moments([0.0])[0]):
            return 0.0
        for _ in range(HALVINGS // int(math.log2(SECTIONS))):
            tried = [low + (high - low) * i / SECTIONS for i in range(1, SECTIONS)]
            for a, sums in zip(tried, table.moments(tried)):
                if not too_low(a, *sums):
                    high = a
                    break
                low = a
        return high

    found = [0.0]
    if evenness is not None:
        equal, own = (table.entropy(a, *sums) for a, sums in zip((0.0, 1.0), table.moments([0.0, 1.0])))
        target = own + evenness * (equal - own)
        found.append(bisect(lambda a, z, l: table.entropy(a, z, l) > target))
    if target_entropy is not None:
        found.append(bisect(lambda a, z, l: table.entropy(a, z, l) > target_entropy))
    if max_repeats is not None:
        found.append(bisect(lambda a, z, l: table.repeats(a, z, budget) > max_repeats))
    return max(found)


# ------------------------------------------------------------------------------------- stream


def digest_order(*parts: Column | str) -> Column:
    """A digest of the parts, as a text of hexadecimal digits that orders like a random number."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit("null")) for c in columns]
    return F.md5(F.concat_ws("|", *texts).cast("binary"))


def leading_number(digest: Column, digits: int) -> Column:
    return F.conv(F.left(digest, F.lit(digits)), 16, 10).cast("long")


def entries(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(key, source, name, digest, tokens, copy): a row per document. Rows of equal key, source and text
    are counted before they are shuffled, and numbered; ``name`` tells sources apart, null too."""
    value = F.col(f"`{text}`")
    plain = docs.select(
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{source}`").alias("source"),
        F.md5(F.coalesce(value, F.lit("")).cast("binary")).alias("digest"),
        token_count(value).alias("tokens"),
    )
    counted = plain.groupBy("key", "source", "digest", "tokens").agg(F.count("*").alias("copies"))
    name = F.when(F.col("source").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return counted.select("key", "source", name.alias("name"), "digest", "tokens", copy.alias("copy"))


def stream(
    docs: DataFrame,
    target_entropy: float | None,
    max_repeats: float | None,
    budget: float | None,
    evenness: float | None,
    block_tokens: int,
    block_rows: int,
    seed: int,
    key: str,
    source: str,
    text: str,
) -> DataFrame:
    """(key, source, digest, tokens, epoch, block, position, exponent, weight)."""
    kept = kept_table(entries(docs, key, source, text), "documents")
    totals = kept.groupBy("name").agg(F.sum("tokens").alias("total"), F.count("*").alias("key_rows"))
    totals = kept_table(totals, "sources")
    shares = Shares.of_table(totals)
    exponent = solve_exponent(shares, target_entropy, max_repeats, budget, evenness)
    rows, whole = totals.agg(F.sum("key_rows"), F.sum("total")).first()
    z = shares.moments([exponent])[0][0] if shares else 1.0
    length = budget if budget is not None else (z / shares.most ** (exponent - 1) if shares else 1.0)

    share = F.col("total") / F.lit(whole or 1)
    weight = F.when(F.col("total") > 0, F.pow(share, F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    # Rounded, so that a source that is read exactly once is not read 0.9999 times.
    reads = F.when(F.col("total") > 0, F.round(F.lit(float(length)) * F.col("weight") / share, 9)).otherwise(F.lit(1.0))
    blocks = F.greatest(
        F.lit(1), F.ceil(F.col("total") / block_tokens), F.ceil(F.col("key_rows") / block_rows)
    ).cast("long")
    plan = totals.withColumn("weight", weight).withColumn("reads", reads).withColumn("blocks", blocks)
    dealt = join_unique(kept, plan, "name", rows or 0).withColumn(
        "block", F.pmod(leading_number(digest_order("key", "digest", "copy", F.lit(seed)), 15), F.col("blocks"))
    )
    return laid_out(dealt, seed).withColumn("exponent", F.lit(exponent))


def laid_out(dealt: DataFrame, seed: int) -> DataFrame:
    """Documents in budgeted block permutations. Windows run over the documents of a block and, for
    the blocks of a pass, in two levels over runs of them: never over a whole source."""
    in_order = [digest_order("key", "digest", "copy", "block", F.lit(seed + 1)), *map(F.col, ("key", "digest", "copy"))]
    in_block = Window.partitionBy("name", "block").orderBy(*in_order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("before", F.coalesce(F.sum("tokens").over(in_block), F.lit(0)))
    blocks = dealt.groupBy("name", "block", "blocks", "reads").agg(F.sum("tokens").alias("block_tokens"))
    last = F.greatest(F.ceil("reads").cast("int") - 1, F.lit(0))
    passes = blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0), last)))
    passes = passes.withColumn("at", digest_order("block", "epoch", F.lit(seed + 2)))
    runs = F.ceil(F.col("blocks") / RUN_BLOCKS)
    passes = passes.withColumn("run", F.floor(leading_number(F.col("at"), 8) * runs / F.lit(2.0**32)))
    starts = sum_before(passes, ["name", "epoch"], "run", [F.col("at"), F.col("block")], "block_tokens", "start")
    read = placed.join(starts.select("name", "block", "epoch", "start").hint("merge"), ["name", "block"])
    at = F.col("start") + F.col("before")
    quota = F.col("reads") * F.col("total")
    # A pass that is read to its end takes everything; the last one what starts within the budget.
    full = F.col("epoch") + 1 <= F.col("reads")
    inside = full | (F.col("epoch") * F.col("total") + at < quota)
    position = F.when(quota > 0, (F.col("epoch") * F.col("total") + at) / quota).otherwise(0.0)
    return read.where(inside).select(
        "key",
        "source",
        "digest",
        "tokens",
        "epoch",
        "block",
        F.least(position, F.lit(1 - 2.0**-53)).alias("position"),
        "weight",
    )


def mixture(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = 1.0,
    evenness: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    block_rows: int = BLOCK_ROWS,
    seed: int = 0,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The stream: (key, source, tokens, epoch, block, position, exponent, weight), a row per reading of
    a document.

    ``budget`` is the stream's length in lengths of the data; None stands for the shortest that
    reads every source once at least, so that none is cut. For the targets see ``solve_exponent``.
    ``position`` in [0, 1) is the place in the stream: sorted by it, any long stretch has the target
    weights, and its pass ``epoch`` comes whole before the next. Sources of null are a source of their
    own. Rows of the same key and text are one document each, rows without a key too; a document
    without words fills no budget and is read in every whole pass, never in a cut one. Of a cut pass,
    documents are read as long as they start within the budget. An empty table gives no rows; other
    columns do not matter. Sources may be as many as there are documents.
    """
    read = stream(
        docs, target_entropy, max_repeats, budget, evenness, block_tokens, block_rows, seed, key, source, text
    )
    names = {"key": key, "source": source}
    return read.drop("digest").withColumnsRenamed(names).select(
        key, source, "tokens", "epoch", "block", "position", "exponent", "weight"
    )


def mixed_documents(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = 1.0,
    evenness: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    block_rows: int = BLOCK_ROWS,
    seed: int = 0,
) -> DataFrame:
    """The documents themselves (doc_id, source, text and other columns), as often as ``mixture``
    reads them; the order of rows says nothing.

    Rows equal in id, source and text are copies of one document: all its readings show one of them,
    and only that one is joined.
    """
    read = stream(
        docs, target_entropy, max_repeats, budget, evenness, block_tokens, block_rows, seed, "doc_id", "source", "text"
    )
    counted = read.groupBy("key", "source", "digest").agg(F.count("*").alias("n readings"))
    digest, place = fresh(docs, "text digest", "copy place")
    marked = docs.withColumn(digest, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    same = Window.partitionBy("doc_id", "source", digest).orderBy(digest)
    one = marked.withColumn(place, F.row_number().over(same)).where(F.col(place) == 1).alias("one")
    times = counted.toDF("read key", "read source", "read digest", "n readings")
    met = one.join(
        times.hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("read key"))
        & F.col("source").eqNullSafe(F.col("read source"))
        & (F.col(digest) == F.col("read digest")),
    )
    again = met.withColumn(place, F.explode(F.sequence(F.lit(1).cast("long"), F.col("n readings"))))
    return again.select(*(F.col(f"`{c}`") for c in docs.columns))
