"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.functions.lineage import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component is its smallest node.

    Alternates two steps until no link changes: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours. Each step is a minimum per node and a join, both
    spread by node, and the number of rounds grows with the logarithm of the longest chain. The
    links of a round are a written table, so a lost executor costs one round at most.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    edges = written(ordered.distinct(), "links")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # larger neighbours go to the smallest
        large = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        down = written(large, "links").select(F.col("b").alias("a"), F.col("a").alias("b"))
        # a node and its smaller neighbours go to the smallest
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        edges = written(small.filter("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    star = edges.groupBy("b").agg(F.min("a").alias("component")).withColumnRenamed("b", "node")
    return star.unionByName(star.select(F.col("component").alias("node"), "component").distinct())
