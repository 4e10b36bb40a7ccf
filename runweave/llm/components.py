"""Connected components over a table of links, by rounds of joins (large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runweave.llm.store import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(work: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(item, component) of every item in `links` (columns a, b of one integer type); component is its least item.

    Null ends and loops are ignored; an empty table gives an empty table. A node's least neighbour is a partial
    aggregate, so a node with very many links leaves each task as one row. Only two numbers reach the driver in a
    round: the count of links and the sum of their hashes, which end the rounds when they stop changing.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = work.keep(edges.where("a is not null and b is not null and a <> b").distinct(), f"{name}-0")
    seen, step = None, 0
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, step = now, step + 1
        edges = work.keep(_small_star(_large_star(edges)), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
    roots = edges.select(F.col("b").alias("item")).distinct()
    return edges.select(F.col("a").alias("item"), F.col("b").alias("component")).union(
        roots.select("item", F.col("item").alias("component")))
