"""Connected components of an edge table, on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgkin.llm.common import written


def _lowest(pairs: DataFrame) -> DataFrame:
    """For each ``u`` the smallest of itself and its ``v``; summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, component``: every node with an edge to another one, and the
    smallest node it can reach.

    Large-star and small-star steps alternate until nothing changes; each step rewires an
    edge to the lowest neighbour, so hubs turn into flat stars and a chain of n edges takes
    O(log n) rounds. Edges with a null or equal ends are ignored.
    """
    lower = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = written(lower.filter("u > v").distinct(), "components")
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: the higher neighbours of u go to its lowest neighbour
        large = (
            now.select(F.col("u").alias("h"), F.col("v").alias("u")).join(_lowest(both), "u")
            .select(F.col("h").alias("u"), F.col("m").alias("v")).distinct()
        )
        # small star: u and its lower neighbours go to the lowest of them
        low = _lowest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = written(
            small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u > v").distinct(),
            "components",
        )
        marks = [
            df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first() for df in (now, after)
        ]
        now = after
        if marks[0] == marks[1]:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
