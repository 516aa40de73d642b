"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import stored


def _to_least_neighbour(links: DataFrame, nodes_seen: DataFrame) -> DataFrame:
    """(a, b) of ``links`` becomes (b, least node that a meets in ``nodes_seen``, or a itself)."""
    least = nodes_seen.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").select(
        F.col("b").alias("a"), F.least("m", "a").alias("b"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _to_least_neighbour(both, both).where("a > b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    # Every link points from the larger node to the smaller.
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").unionByName(
        least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, put: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node it reaches.

    Links move towards the least neighbour, over large and then over small neighbours in turn,
    until they form stars. The number of rounds grows with the logarithm of the longest path;
    a node with many links is only ever joined with one row. A link of a node to itself or
    with a null says nothing and is left out. No link gives no row.
    """
    now = put(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a > b").distinct(), "links")
    before = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if mark == before or mark[0] == 0:
            break
        before = mark
        now = put(_small_star(put(_large_star(now), "stars")), "stars")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
