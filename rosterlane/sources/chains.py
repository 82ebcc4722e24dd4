"""Chains of pages: each names the token of the next one, and the last names none.

A page that did not land leaves no trace but in the page before it, so chains are followed to the end:
as linked lists, by pointer doubling. Every round each page learns where the page it points to points,
so a chain of n pages takes log2(n) rounds, each a join on (parents, token), which no two pages share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlane.operators.columns import quoted
from rosterlane.sinks.files import shared_folder

# The token a page was asked for with; of the first page of a chain it is blank.
PAGE_TOKEN = "page_token"
NEXT_TOKEN = "next_page_token"

COMPLETE = "complete"
HOLE = "hole"
CYCLE = "cycle"
FORKED = "forked"
NO_START = "no first page"
UNREACHED = "pages out of reach"


def page_chains(
    pages: DataFrame, parents: Sequence[str], token: str = PAGE_TOKEN, next_token: str = NEXT_TOKEN
) -> DataFrame:
    """One row per parent: ``pages``, ``chained`` (pages from the first one on), ``state`` and the
    ``missing`` token of a hole.

    States: complete; hole (the chain goes on to a page that is not there); cycle (it comes back to a
    page; nothing is chained); forked (one token has pages that go on differently); no first page; pages
    out of reach (the chain ends before all of them). A page that landed twice is one page. Tokens are
    compared without white space around them.
    """
    names = [f"parent {i}" for i in range(len(parents))]
    pointers = pages.select(
        *(F.col(quoted(p)).alias(n) for p, n in zip(parents, names)),
        _clean(token).alias("at"),
        _clean(next_token).alias("to"),
    )
    links = pointers.groupBy(*names, "at").agg(
        F.count("*").alias("pages"), F.min("to").alias("to"), (F.min("to") != F.max("to")).alias("forked")
    )
    followed = _followed(links, names)
    groups = followed.groupBy(*names).agg(
        F.sum("pages").alias("pages"),
        F.count("*").alias("different"),
        F.bool_or("forked").alias("forked"),
        *(F.max(F.when(F.col("at") == "", F.col(c))).alias(c) for c in ("state", "hops", "to")),
    )
    state = (
        F.when(F.col("forked"), FORKED)
        .when(F.col("state").isNull(), NO_START)
        .when(F.col("state") != COMPLETE, F.col("state"))
        .when(F.col("hops") < F.col("different"), UNREACHED)
        .otherwise(COMPLETE)
    )
    chained = state.isin(COMPLETE, HOLE, UNREACHED)
    return groups.select(
        *(F.col(n).alias(p) for n, p in zip(names, parents)),
        "pages",
        F.when(chained, F.col("hops")).alias("chained"),
        state.alias("state"),
        F.when(state == HOLE, F.col("to")).alias("missing"),
    )


def _clean(token: str) -> Column:
    return F.coalesce(F.btrim(F.col(quoted(token)).cast("string")), F.lit(""))


def _followed(links: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add to every page how its chain goes on: ``state``, ``hops`` (pages from it on) and, at a hole,
    ``to``, the token that is missing."""
    shared_folder(links.sparkSession)
    state = F.when(F.col("to") == "", F.lit(COMPLETE))
    known = links.withColumns({"state": state, "hops": F.lit(1).cast("long")}).checkpoint()
    groups = known.groupBy(*names).agg(F.count("*").alias("n"))
    most = groups.agg(F.max("n")).first()[0] or 0
    reach = 1
    while reach <= most and not known.where("state is null").isEmpty():
        known = _doubled(known, names).checkpoint()
        reach *= 2
    # Who has come further than there are pages, and not to an end, goes round.
    return known.withColumn("state", F.coalesce("state", F.lit(CYCLE)))


def _doubled(known: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every page on its way points as far as the page it points to."""
    ahead = known.select(
        *(F.col(n).alias(f"ahead {n}") for n in names),
        F.col("at").alias("ahead at"),
        *(F.col(c).alias(f"ahead {c}") for c in ("to", "state", "hops")),
    )
    going = F.col("state").isNull()
    on = going & (F.col("to") == F.col("ahead at"))
    for n in names:
        on &= F.col(n).eqNullSafe(F.col(f"ahead {n}"))
    there = F.col("ahead at").isNotNull()
    return known.join(ahead, on, "left").select(
        *names,
        "at",
        "pages",
        "forked",
        F.when(going & there, F.col("ahead to")).otherwise(F.col("to")).alias("to"),
        F.when(~going, F.col("state")).when(there, F.col("ahead state")).otherwise(F.lit(HOLE)).alias("state"),
        (F.col("hops") + F.when(going & there, F.col("ahead hops")).otherwise(0)).alias("hops"),
    )
