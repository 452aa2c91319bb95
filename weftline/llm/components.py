"""Connected components of links, on Spark alone: alternating large and small stars, written after each round.

In a round every node hands its larger neighbours to the smallest node it knows (large star), then its smaller ones (small
star). The edges end as one star per component around its smallest node, after about log(n) rounds. A node's minimum is an
aggregate with partial sums and is joined back by node, so a node with very many neighbours is never one list; the join can be
split where it is uneven.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import written


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large(edges: DataFrame) -> DataFrame:
    pairs = _both(edges)
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = pairs.join(least, "a").where(F.col("b") > F.col("a"))
    return moved.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a != b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, component (its smallest node) of every node that a link of links (a, b: longs) touches but the smallest."""
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    before = None
    for _ in range(most_rounds):
        edges = written(_small(_large(edges)), "edges")
        sums = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if sums == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = sums
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
