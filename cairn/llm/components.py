"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.staging import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connect(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node of ``links`` (``a``, ``b``).

    A round points every neighbour above a node, then every neighbour below it, at the smallest node
    around; rounds end when nothing changes, after about the logarithm of the longest path. Smallest
    neighbours are found by partial sums, so a node with very many links is no single task. Each round
    is written to the shared folder. Links of a node with itself, repeated and null ones do no harm.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state, before = _state(edges), None
    while state != before:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        lower = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(least.select("a", F.col("m").alias("b")).unionByName(lower).distinct(), "edges")
        state, before = _state(edges), state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
