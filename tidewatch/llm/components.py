"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import rest


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows node, root (the smallest node of its component) for nodes of ``edges (a, b)``.

    Alternates two steps until nothing changes: each node's larger neighbours are
    hung on its smallest neighbour, then its smaller ones are. Both are a minimum per
    node, combined before the shuffle, and a join that Spark can split, so a node
    with very many edges never meets them in one task. Each step rests as a table.
    """
    links = rest(_ordered(edges), name)
    seen = None
    while True:
        links = rest(_small_star(_large_star(links)), name)
        state = tuple(
            links.agg(
                F.count("*"),
                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            ).first()
        )
        if state == seen:
            break
        seen = state
    own = links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(own)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node ``a`` to its smaller node ``b``."""
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return turned.where("a != b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    moved = both.join(least, both["a"] == least["n"]).where("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select(F.col("a").alias("n"), "m")
    joined = links.join(least, links["a"] == least["n"])
    # A node's other smaller neighbours, and the node itself, go to the smallest.
    moved = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()
