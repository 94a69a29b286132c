"""Connected components of a link table by alternating large and small stars.

Each round rewrites the links so that every node points to the smallest
neighbour it knows; the rounds end when every link leads to a node without one.  A round is
one partial aggregate and one join per star, written under
``spark.checkpoint.dir``, so lineage stays short and a lost executor costs at
most one round.  Links are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.scratch import saved

_ROUNDS = 60  # stars of n nodes converge in O(log n) rounds; this many means a fault


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the smallest of
    its neighbourhood.  Small star: so are the smaller neighbours and the node."""
    if large:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.where("a != b").distinct()


def _settled(links: DataFrame) -> bool:
    """Every node has one link, to a node that has none itself: the links are the components."""
    twice = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    further = links.select("b").join(links.select(F.col("a").alias("b")), "b", "left_semi").select(F.col("b").alias("a"))
    return twice.unionAll(further).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that ``links`` (a, b) lead to, for
    every node that has a link."""
    links = saved(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    for _ in range(_ROUNDS):
        if _settled(links):
            break
        links = saved(_star(_star(links, True), False))
    else:
        raise RuntimeError("components did not converge")
    found = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
