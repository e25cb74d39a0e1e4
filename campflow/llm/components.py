"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campflow.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every linked node: the root is the smallest node that can be reached (itself, for a root).

    ``links`` has two columns of one ordered type; direction, repeats and loops do not matter, rows with null are left
    out. Stars are alternately drawn around the smallest neighbour of every node and around that of every node's
    smaller ones, until nothing changes: about log(longest path) rounds. Each round is written as a table. The
    smallest neighbour comes from an aggregation and a join, which Spark splits where a node has very many links.
    """
    x, y = (F.col(f"`{name}`") for name in links.columns)
    pairs = links.filter(x.isNotNull() & y.isNotNull()).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    pairs = stage(pairs.filter("a > b").distinct(), "links")
    seen = _digest(pairs)
    while True:
        pairs = stage(_towards_smaller(_towards_smallest(pairs)), "links")
        now = _digest(pairs)
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _digest(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _towards_smallest(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest among the node and its neighbours."""
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    larger = both.join(lowest, "a").filter("b > a and b > low")
    return larger.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _towards_smaller(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    lowest = pairs.groupBy("a").agg(F.min("b").alias("low"))
    moved = pairs.join(lowest, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionAll(lowest.select("a", F.col("low").alias("b"))).distinct()
