"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from desklake.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of node and neighbours."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node and the smallest node reachable from it, for nodes with an edge. ``edges`` has u and v of any ordered type.

    Both steps fold with a map-side minimum and join on it, so the neighbours of a hub are never gathered; the number of rounds grows
    with the logarithm of the longest path.
    """
    state, mark = stored(edges.select("u", "v").where("u <> v").distinct(), "components"), None
    for _ in range(rounds):
        state = stored(_small_star(_large_star(state)), "components")
        seen = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
