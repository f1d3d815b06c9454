"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import Scratch

_SALTS = 8                                    # tasks that share the edges of one high-degree node


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    dealt = both.filter("v > u").withColumn("salt", F.pmod(F.hash("v"), F.lit(_SALTS)))
    return (dealt.join(low, ["u", "salt"])
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node that has an edge; component = smallest node.

    ``edges`` has long columns u and v.  Each step is a map-side combined
    minimum and a join on the node, salted by the neighbour, so the edges of
    the high-degree node of a large group spread over several tasks; intermediate edges are written tables.
    Self-loops and repeated edges are allowed; a node with only self-loops
    gets no row.
    """
    now = scratch.stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                                       F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    step, mark = 0, None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark, step = state, step + 1
        now = scratch.stage(_small_star(_large_star(now)), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
