"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work


def components(links: DataFrame, work: Work) -> DataFrame:
    """`(node, component)` for every node with a link; the component is its smallest node.

    `links` has the long columns `a` and `b`. Alternating large-star and small-star steps: every round hooks
    the neighbours of a node to the smallest of them, so paths halve. A node's neighbours are only reduced to
    their minimum, which is partially aggregated, and joined back, which splits hot nodes.
    """
    edges = work.keep(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = (
            both.join(least, "a").where("b > a and b != low")
            .select(F.col("low").alias("a"), "b").distinct())
        large = work.keep(large, "large")
        least = large.groupBy("b").agg(F.min("a").alias("low"))
        joined = large.join(least, "b")
        small = (
            joined.where("a != low").select(F.col("low").alias("x"), F.col("a").alias("y"))
            .unionByName(joined.select(F.col("low").alias("x"), F.col("b").alias("y"))).distinct())
        found = work.keep(small.toDF("a", "b"), "small")
        work.drop(large)
        state = found.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        work.drop(edges)
        edges = found
        if state == before or not state[0]:
            break
        before = state
    hooked = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return hooked.unionByName(hooked.select(F.col("component").alias("node"), "component").distinct())
