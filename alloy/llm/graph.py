"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from alloy.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of ``edges``
    (a, b; longs).

    Alternating large and small stars: each round hangs a node's greater
    neighbours, then its smaller ones, on the smallest it knows. Minima are
    folded before each shuffle and the joins are plain equi-joins on both
    sides' exchanges, so a node with very many neighbours is split at run time.
    Rounds grow with the logarithm of the longest path."""
    pairs = written(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = written(small.filter("u != v").distinct(), "small-star")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return written(stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct()), "components")
        state = now
