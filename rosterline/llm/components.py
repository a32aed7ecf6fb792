"""Connected components of a table of links, in a number of rounds that grows with the logarithm
of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node it is linked with, also through others) of all nodes.

    ``links`` has long columns a and b. Each round ties every node to the smallest of its
    neighbours, first its larger ones, then its smaller ones, and stores the result; when nothing
    changes every node hangs on its root. Aggregates are combined before the shuffle and stored
    before they are joined, so that a node with very many links is split.
    """
    edges = settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct())
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")))
        large = settle(
            both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("root").alias("b")).distinct())
        least = settle(large.groupBy("a").agg(F.min("b").alias("root")))
        edges = settle(
            large.join(least, "a").filter("b <> root")
            .select(F.col("b").alias("a"), F.col("root").alias("b"))
            .unionByName(least.withColumnRenamed("root", "b")).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Row count and a checksum that does not depend on the order."""
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
