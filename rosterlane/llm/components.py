"""Connected components of a graph given by its links, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlane.llm.common import join_unique, kept_table


def least_neighbour(edges: DataFrame, rows: int) -> DataFrame:
    """Every edge (u, v) with ``m``, the smallest neighbour of u. A node of many edges is no burden:
    its minimum is taken before the shuffle and comes back by broadcast."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("key_rows"))
    return join_unique(edges, least, "u", rows).select("u", "v", "m")


def large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = least_neighbour(both, 2 * rows).where("v > u")
    return found.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, are linked to the smallest of them."""
    found = least_neighbour(edges, rows)
    ends = F.explode(F.array("u", "v")).alias("u")
    return found.select(ends, F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) can reach.

    Rounds of large and small stars go on until every node hangs on its root; the number of rounds
    grows with the logarithm of the nodes. Nodes without links do not occur. Each round is written to
    the shared folder, so a lost executor costs one round at most.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = kept_table(edges.where("u <> v").distinct(), "links")

    def state(table: DataFrame) -> tuple:
        return tuple(table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        rows = now[0]
        starred = kept_table(large_star(edges, rows), "links")
        edges = kept_table(small_star(starred, starred.count()), "links")
        before, now = now, state(edges)
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
