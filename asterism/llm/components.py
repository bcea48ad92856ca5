"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import stored


def _smallest(pairs: DataFrame) -> DataFrame:
    """(u, v) with the smallest of u and its neighbours v as m.

    The minima are a table of their own, so that both sides of the join come
    from a shuffle and a hub with very many neighbours can be split.
    """
    low = stored(pairs.groupBy("u").agg(F.min("v").alias("m")), "hub")
    return pairs.join(low, "u").select("u", "v", F.least("u", "m").alias("m"))


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = stored(large.distinct(), "large")
    small = _smallest(large)
    pairs = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        small.select("u", F.col("m").alias("v"))
    )
    return stored(pairs.filter("u > v").distinct(), "small")


def _are_stars(edges: DataFrame) -> bool:
    """Every node has edges to larger nodes only, or one edge to a smaller one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    roles = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return roles.filter("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link to another one.

    ``component`` is the smallest node that can be reached. Links may repeat,
    run in either direction or join a node with itself; null ends are ignored.
    Each round is written to the shared scratch folder; their number grows with
    the logarithm of the largest component, and links that are stars with the
    smallest node in the middle take none.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stored(edges.filter("u > v").distinct(), "links")
    while not _are_stars(edges):
        edges = _round(edges)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
