"""Connected components of an edge table by alternating large-star and small-star rounds, DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import written


def _state(edges: DataFrame) -> tuple:
    """Size and hash of an edge set; two rounds of equal state have the same edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) for every node of an edge with two different ends; component is the smallest node reachable.

    Null ends and loops are left out; repeated edges count once. Each round is written to the shared folder, so a lost
    executor costs one round at most. Joins split hot nodes (adaptive skew joins), and every minimum is pre-aggregated
    before the shuffle. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.select(F.col(src).alias("x"), F.col(dst).alias("y")).where("x <> y")
    pairs = pairs.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    now = written(pairs, "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours point to the smallest neighbour
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: smaller neighbours and the node itself point to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
