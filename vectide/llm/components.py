"""Connected components of an edge table, by alternating large and small stars.

After each pair of rounds every edge points from a node to a lower one that is nearer
to the component's lowest node; the table never grows beyond the edges it started
with, and it takes few rounds also for long chains. Each round is written to the
shared folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectide.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every higher neighbour of a node is hung on the lowest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its lower neighbours are hung on the lowest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the lowest node of its component, of every node but the roots.

    ``edges`` has comparable, non-null ``u`` and ``v``, in any direction and with
    repeats; nodes without an edge to another are left out.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct())
    before = None
    while True:
        now = written(_small_star(_large_star(now)))
        # A star of all edges is final: it is left unchanged by another round.
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
