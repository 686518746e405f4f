"""Connected components of a link table by alternating large-star and small-star steps.

Each step is a minimum per node (combined before the shuffle) and a join, so a node with many links is never
gathered anywhere; every round is written to the shared folder, and a round that changes nothing ends it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import park


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. links: a, b of an ordered type, without nulls."""
    current = park(links.select("a", "b").filter("a <> b").distinct(), "links")
    state = _state(current)
    while state[0]:
        current = park(_small_star(_large_star(current)), "links")
        before, state = state, _state(current)
        if state == before:
            break
    labels = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.union(current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
