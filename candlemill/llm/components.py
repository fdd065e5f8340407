"""Connected components of a link table, by alternating large and small stars.

Every round is two aggregates and two joins over the links; a hub with a large
share of them shrinks on the map side, and the join back to it is split.  Each
round is checkpointed, so a lost executor costs one round at most, and only two
numbers come to the driver per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.operators.keyed import match_keyed
from candlemill.workspace import checkpointed


def _with_least(links: DataFrame) -> DataFrame:
    """Links (a, b) with ``least``, the smallest of a and all its neighbours b."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return match_keyed(links, least, ["a"], "inner")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _with_least(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    downward = links.where("a > b")
    joined = _with_least(downward)
    return joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        joined.select("a", F.col("least").alias("b"))
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b); root is the smallest node it reaches.

    Equal ends are no link; repeated links and an empty table are fine.
    """
    links = checkpointed(links.where("a <> b").select("a", "b").distinct())
    seen = None
    while True:
        links = checkpointed(_small_star(_large_star(links).distinct()).distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root"))
    ).distinct()
