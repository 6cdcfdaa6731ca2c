"""Connected components of a link table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vendorium.llm.scratch import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    both = both.select(F.col("high").alias("node"), F.col("low").alias("other"))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    joined = both.filter("other > node").join(least, "node")
    return joined.select(F.col("other").alias("high"), F.least("node", "least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(least, "high").filter("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return joined.unionByName(least.select("high", F.col("least").alias("low"))).distinct()


def connected_components(links: DataFrame, scratch: Scratch, label: str = "stars") -> DataFrame:
    """(node, component) for every node of links (low, high): the smallest node reachable.

    Each turn is two groupings with joins; a node's neighbours are never gathered in one place. The table never has
    more rows than links, and the number of turns grows with the logarithm of the longest chain. Turns end when the
    table no longer changes. Links of a node to itself and repeated links do no harm.
    """
    edges = links.select(F.greatest("low", "high").alias("high"), F.least("low", "high").alias("low")).filter("low < high").distinct()
    edges = scratch.write(edges, f"{label}-0")
    turn, before = 0, None
    while True:
        turn += 1
        edges = scratch.write(_small_star(_large_star(edges)), f"{label}-{turn}")
        scratch.drop(f"{label}-{turn - 1}")
        mark = F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
        now = edges.agg(F.count("*"), mark).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return roots.unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
