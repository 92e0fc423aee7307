"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alula.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them. Needs u > v."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(smallest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (two columns of longs).

    Large-star and small-star steps alternate until nothing changes; each step needs a minimum per node and a join,
    never a node's neighbours in one place. Links of a node with itself and links with a null are ignored; nodes
    without other links do not appear. Every step's links are written, so a lost executor costs one step."""
    a, b = links.columns
    current = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where((F.col(a) != F.col(b))).distinct(), "links"
    )

    def state(df: DataFrame):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return r["n"], r["x"]

    before = state(current)
    while before[0]:
        current = written(_small_star(_large_star(current)), "links")
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("v").alias("node")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
