"""Connected components of links, as star contraction over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.frames import written_table


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long) but the roots themselves.

    A root is the least node of its component. Each round hangs the larger neighbours of a
    node on its least neighbour, then the smaller ones; rounds end when nothing changes,
    after some log(n) of them. Least neighbours are aggregated before they are joined, and
    the joins are between stored tables, so Spark may split a node with very many links.
    """
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = written_table(pairs.where("u != v").distinct(), "links")
    state = _summary(edges)
    while True:
        both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = written_table(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = written_table(large.distinct(), "large-star")
        least = written_table(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
        edges = written_table(small.distinct(), "links")
        before, state = state, _summary(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
