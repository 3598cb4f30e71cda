"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every end of a link in ``links(a, b)``.

    ``component`` is the smallest node that can be reached.  In each round every
    node moves to the neighbour, or itself, that has most links, and links
    between nodes that have met vanish.  A star is gone in one round; among
    equals an order drawn anew decides, so chains shrink by a fixed share in
    expectation.  Counts and minima combine before the shuffle, so a node with a
    third of all links is no burden.  Rounds are cut by written tables.  Links of
    a node to itself and null ends are ignored.
    """
    edges = stage(_tidy(links.select("a", "b")), "links")
    labels = None
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c, n: F.struct(-F.col(n), F.xxhash64(F.lit(turn), c), F.col(c).alias("node"))
        degrees = both.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
        ranked = degrees.select("a", rank("a", "_n").alias("_own"))
        onto = ranked.select(F.col("a").alias("b"), F.col("_own").alias("_other"))
        best = both.join(onto, "b").groupBy("a").agg(F.min("_other").alias("_best"))
        moves = best.join(ranked, "a").select("a", F.least("_own", "_best").alias("_to"))
        moves = stage(moves.select(F.col("a").alias("node"), F.col("_to.node").alias("to")), "moves")
        if labels is None:
            labels = moves
        else:
            onward = moves.select(F.col("node").alias("_at"), F.col("to").alias("_on"))
            labels = labels.join(onward, labels["to"] == onward["_at"], "left")
            labels = labels.select("node", F.coalesce("_on", "to").alias("to"))
        a = moves.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        b = moves.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        moved = edges.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = stage(_tidy(moved), "links")
        labels = stage(labels, "labels")
        turn += 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    smallest = labels.groupBy("to").agg(F.min("node").alias("component"))
    return labels.join(smallest, "to").select("node", "component")


def _tidy(links: DataFrame) -> DataFrame:
    """Each link once, from the larger end to the smaller."""
    return (
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
