"""Connected components of an undirected graph of long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import materialise


def _relinked(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Tie every neighbour of a node to the smallest id around the node.

    ``both_ways`` looks at all neighbours and moves the larger ones, otherwise
    at the smaller neighbours only and moves those and the node itself. Minima
    are combined before the shuffle, so a node with very many links is no problem.
    """
    if both_ways:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("a", "m").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("at"))
    if both_ways:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("at").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _pairs(edges: DataFrame) -> DataFrame:
    a, b = edges.columns[:2]
    return edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()


def condensed(edges: DataFrame) -> DataFrame:
    """One round of both relinking steps: other links of the same components, mostly already to their smallest ids."""
    return materialise(_relinked(_relinked(_pairs(edges), True), False), "links")


def labels(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id that a node is linked with, itself included.

    Equal labels mean one component; of links that have not converged, one component may have several.
    """
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select(F.col("component").alias("node"), "component")).groupBy("node").agg(F.min("component").alias("component"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest id reachable, for every node with a link.

    Alternates the two relinking steps until nothing changes; the number of
    rounds grows with the logarithm of the longest chain. Every round is written
    to the shared folder, so a lost executor costs one round at most. Links from
    a node to itself and repeated links are ignored; no links give no rows.
    """
    now, seen = materialise(_pairs(edges), "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = condensed(now)
    return labels(now)
