"""Connected components of an edge table by alternating stars.

Each step makes every node point at smaller nodes of its neighbourhood; after a
few steps only stars around the smallest node of each component remain. Per-node
minima are aggregates (partial on the map side), and come back to the edges by
node and one of ``PARTS`` parts of its edges, so a hub with very many neighbours is
spread over as many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Workspace


PARTS = 32


def _with_low(edges: DataFrame, low: Column) -> tuple[DataFrame, DataFrame]:
    """The edges with the minimum ``low`` of their node ``a``, and (a, low) of every node."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(PARTS)).cast("int"))
    nodes = dealt.groupBy("a").agg(low.alias("low"), F.bit_or(F.expr("shiftleft(1, part)")).alias("parts"))
    held = F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit("parts", p) == 1)
    return dealt.join(nodes.select("a", "low", F.explode(held).alias("part")), ["a", "part"]), nodes.select("a", "low")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, _ = _with_low(both, F.least(F.min("b"), F.first("a")))
    return joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a > b."""
    joined, low = _with_low(edges, F.min("b"))
    moved = joined.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(ws: Workspace, edges: DataFrame, name: str) -> DataFrame:
    """(a, b): each node with edges and the smallest node it reaches (roots themselves left out)."""
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    before, step = None, 0
    while True:
        now = ws.save(_small_star(_large_star(pairs)) if step else pairs, f"{name}-{step}")
        state = now.select(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1000003)).first()
        if step > 1:
            ws.drop(f"{name}-{step - 1}")
        if tuple(state) == before or not state[0]:
            return now
        pairs, before, step = now, tuple(state), step + 1
