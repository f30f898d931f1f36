"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import saved


def _step(edges: DataFrame, large: bool) -> DataFrame:
    """Large-star links each larger neighbour of u to the least of u's
    neighbourhood; small-star does it for u and its smaller neighbours."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of ``edges`` (u, v; not null) with the least node
    that it reaches. Nodes without edges are not listed. Every round is written
    to the shared folder; the number of rounds grows with the logarithm of the
    number of nodes. A round groups by node with partial sums, and only joins
    that Spark can split carry a node's neighbours."""
    now = saved(edges.select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        # a fixed point: every node points at a root
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if state == before or not state["n"]:
            break
        before = state
        now = saved(_step(_step(now, True), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
