"""Connected components of an edge list by alternating large and small stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def _state(edges: DataFrame) -> tuple:
    """Equal for equal edge sets whatever the order of rows (no floating-point sums)."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of ``edges`` (long columns a, b) and the smallest node it
    is connected to, itself included.

    A large star links a node's larger neighbours to its smallest neighbour, a small star its
    smaller neighbours and itself; both keep components, and the edges become one star per
    component after a number of rounds that grows with the logarithm of the size.  A node of
    any degree only meets one aggregated row."""
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    current = stage(edges.select(hi.alias("a"), lo.alias("b")).where("a <> b").distinct(), "edges")
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(least, "a")
        small = linked.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        following = stage(small, "edges")
        unstage(current)
        current, before, state = following, state, _state(following)
        if state == before:
            break
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")) \
        .unionByName(roots.select("node", F.col("node").alias("component")))
