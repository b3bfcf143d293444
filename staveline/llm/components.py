"""Connected components of links, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staveline.session import settled


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of (u, v): root is the smallest node that links reach.

    Large and small stars in turn: each node hands its neighbours to the smallest
    of them, until all point at their root. Every turn is stored; the number of
    turns grows with the logarithm of the longest chain. Minima are taken before
    the shuffle, and the joins of a node with very many links are split at run time.
    """
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = settled(edges.distinct(), label)
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = handed.unionByName(smallest.withColumnRenamed("m", "v")).distinct()
        edges = settled(small, label)
        found = _state(edges)
        if found == state:
            break
        state = found
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
