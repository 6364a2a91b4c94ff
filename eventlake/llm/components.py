"""Connected components of a graph kept in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) but the roots themselves, where
    root is the smallest node that node can reach.

    Large-star and small-star steps in turn, until the edges no longer change: then
    each points from a node to its root. No step holds a node's neighbours together;
    their minimum is pre-aggregated, and the joins on a hot node can be split.
    Loops and repeated edges are allowed; no edges give no rows.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = settle(both.filter("a <> b").distinct(), "edges")
    seen = _mark(links)
    while True:
        links = settle(_small_star(_large_star(links)).distinct(), "edges")
        now = _mark(links)
        if now == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def _mark(links: DataFrame) -> tuple:
    """Two sets of edges are taken as equal if this is."""
    number = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(number)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to its smallest neighbour, or to itself."""
    sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = sides.groupBy("a").agg(F.min("b").alias("m"))
    smallest = smallest.select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
    larger = sides.filter("b > a").join(smallest, F.col("a") == F.col("c"))
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    own = smallest.select("a", F.col("m").alias("b"))
    smallest = smallest.select(F.col("a").alias("c"), "m")
    others = links.join(smallest, F.col("a") == F.col("c")).filter("b <> m")
    return own.unionByName(others.select(F.col("b").alias("a"), F.col("m").alias("b")))
