"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kilospan.llm.common import kept

MOST_ROUNDS = 60


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Link neighbours to the least node around: larger ones (large star), or the node
    itself and smaller ones (small star). The least neighbour is an aggregate combined in
    the map tasks; the join back splits hot nodes under adaptive execution."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("centre"), F.least("m", "u").alias("m")
    )
    joined = near.join(least, near["u"] == least["centre"])
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("centre").alias("a"), F.col("m").alias("b"))
        )
    else:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; the component is its least node.

    ``edges`` has two columns a and b of one type; loops, repeats and either direction are
    fine, and no edges give no rows. Rounds grow with the logarithm of the number of nodes.
    Each ends in a written table. Nothing but a checksum comes to the driver.
    """
    state = kept(edges.where("a != b").distinct(), "edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        state = kept(_stars(_stars(state, small=False), small=True), "edges")
        mark = state.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("components did not settle")
    tree = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return tree.union(roots)
