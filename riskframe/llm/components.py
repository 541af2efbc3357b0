"""Connected components of an edge table by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or its not larger) neighbours to its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = low.withColumn("low", F.least("node", "low"))
    linked = both.join(low, both["a"] == low["node"])
    if large:
        out = linked.where("b > node").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            linked.select(F.col("node").alias("a"), F.col("low").alias("b"))
        )
    return out.where("a <> b").distinct()


def _settled(stars: DataFrame) -> bool:
    """Whether every node has one edge as the larger end, or edges as the smaller end only."""
    ends = stars.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(stars.select("b", F.lit(0)))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not counts.agg(F.count_if(F.expr("up > 1 or up = 1 and n > 1"))).first()[0]


def components(edges: DataFrame, stored: bool = False) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for all nodes of ``edges`` (a, b).

    Each step is stored in the shared folder, the edges before the first unless they are ``stored``; steps repeat
    until only stars around smallest nodes are left, which takes logarithmically many. Stars of hot nodes are
    grouped with map-side minima; the joins that distribute them are split by AQE when skewed. Nodes without
    edges are not listed.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    if not stored:
        now = stage(now.distinct(), "edges")
    while True:
        now = stage(_star(_star(now, True), False), "stars")
        if _settled(now):
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
