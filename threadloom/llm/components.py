"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.llm.scratch import Scratch


def _both(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))
    return edges.select(F.explode(ends).alias("e")).select("e.v", "e.w")


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every vertex of ``edges`` (a, b): the smallest id reachable from it.

    Each round every vertex hooks its larger neighbours, then its smaller ones, to its smallest
    neighbour (Kiveris et al., "Connected components in MapReduce and beyond"), which takes O(log^2 n)
    rounds. The minimum is a map-side aggregate and the join is on the vertex, so a star of many leaves
    is handled by partial sums and the adaptive skew join. Rounds are stored tables.
    """
    current = scratch.store(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    state = _state(current)
    rounds = 0
    while state[0]:
        around = _both(current)
        low = around.groupBy("v").agg(F.min("w").alias("low")).select("v", F.least("v", "low").alias("low"))
        large = around.where("w > v").join(low, "v").select(F.col("low").alias("a"), F.col("w").alias("b"))
        large = scratch.store(large.where("a <> b").distinct(), "large")
        down = large.groupBy("b").agg(F.min("a").alias("low"))
        small = large.join(down, "b").select(
            F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("a").alias("b")),
                              F.struct(F.col("low").alias("a"), F.col("b").alias("b")))).alias("e")
        ).select("e.a", "e.b").where("a <> b").distinct()
        small = scratch.store(small, "small")
        before, state = state, _state(small)
        scratch.drop(large, current)
        current, rounds = small, rounds + 1
        if state == before:
            break
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    member = current.select(F.col("b").alias("id"), F.col("a").alias("component"))
    return member.unionByName(member.select(F.col("component").alias("id"), "component").distinct())


def _state(edges: DataFrame) -> tuple:
    """Number of edges and a sum of their hashes: equal when a round changed nothing."""
    value = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(value)).first())
