"""Connected components of a link table, as alternating star joins.

Each round replaces every link by links to the smallest neighbour (large
star, then small star) until the links form stars around the smallest id of
each component.  Minima are pre-aggregated before each shuffle and links are
written to the shared folder after each round; nothing is gathered on the
driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logscan.llm.common import Scratch


def _toward_minimum(arcs: DataFrame) -> DataFrame:
    """(u, v, m) with m the smallest id among u and its neighbours v."""
    low = arcs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return arcs.join(low, "u")


def _round(links: DataFrame) -> DataFrame:
    arcs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = arcs.unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    large = _toward_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    star = _toward_minimum(large)
    small = star.select(F.col("v").alias("b"), F.col("m").alias("a")).unionByName(
        star.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return small.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, comp) for every id of ``links`` (a, b): comp is the smallest id
    reachable.  An empty link table gives an empty result."""
    check = [F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))]
    now = scratch.save(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), f"{name}-0")
    state, k = now.agg(*check).first(), 0
    while state[0]:
        k += 1
        now = scratch.save(_round(now), f"{name}-{k}")
        before, state = state, now.agg(*check).first()
        scratch.drop(f"{name}-{k - 1}")
        if tuple(before) == tuple(state):
            break
    return now.select(F.col("b").alias("id"), F.col("a").alias("comp")).unionByName(
        now.select(F.col("a").alias("id"), F.col("a").alias("comp")).distinct())
