"""Connected groups of a graph of links, by alternating stars.

Each round first links all larger neighbours of a node to its smallest one,
then all smaller ones. A node never gets more than its own links, sums are
formed before shuffles, and every round is written to the shared folder, so a
lost executor repeats a part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.store import stored


def _both(edges: DataFrame) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.union(turned)


def _star(edges: DataFrame) -> DataFrame:
    """All neighbours of a node, and it, to the smallest of them.

    The smallest neighbour is a partial aggregate joined back; a node with
    very many links is split by the join.
    """
    smallest = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return edges.join(smallest, "a")


def roots(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        large = _star(_both(edges)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        star = _star(large)
        small = star.select(F.col("b").alias("a"), F.col("m").alias("b")).union(star.select("a", F.col("m").alias("b")))
        edges = stored(small.where("a <> b").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
