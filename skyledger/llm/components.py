"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import materialize


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame) -> DataFrame:
    """One large-star step and one small-star step over edges (u, v) with u > v."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.join(least, "u").where(F.col("v") > F.col("u"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    nearest = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = (large.join(nearest, "u").where(F.col("v") != F.col("m"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionAll(nearest.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b), where root is its smallest reachable node.

    Loops and repeated edges do no harm; a node without an edge to another is not returned.
    Each round is written to the shared folder, so a lost executor repeats one round at most;
    the number of rounds grows with the logarithm of the largest component. Groups are only
    ever reduced to their smallest member, so a giant component needs no large task.
    """
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = materialize(ends.where(F.col("u") != F.col("v")).distinct(), "edges")
    before, known = None, _fingerprint(current)
    while known != before:
        current = materialize(_star(current), "edges")
        before, known = known, _fingerprint(current)
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
