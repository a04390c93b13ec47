"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm import common as c


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours are hung on the smallest of them."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    hung = both.join(low, "u")
    if large:
        out = hung.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (u, v) -> (node, root): the smallest node reachable, for every
    node that has an edge and is not its own root.  Rounds grow with the
    logarithm of the longest path; each is written to the shared folder."""
    edges = c.written(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        edges = c.written(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
