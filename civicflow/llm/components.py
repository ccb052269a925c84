"""Connected components by alternating large and small stars, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an edge list; component is the smallest node reachable.

    Each round links the larger neighbours of every node to the smallest one,
    then the smaller neighbours, until the edges are stars. Rounds are written
    to the shared folder, so a lost executor costs no more than a round. A hub
    is a skewed join key, which Spark splits.
    """
    pairs = edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct()
    pairs = stored(pairs, "cc_edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above a node move to its smallest neighbour (or to itself)
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("u"), "v").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        down = large.select(F.col("v").alias("x"), F.col("u").alias("y"))
        least = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(least, "x").select(F.col("m").alias("u"), F.explode(F.array("x", "y")).alias("v"))
        after = stored(small.where("u < v").distinct(), "cc_edges")
        state = [d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for d in (pairs, after)]
        pairs = after
        if state[0] == state[1]:
            break
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
