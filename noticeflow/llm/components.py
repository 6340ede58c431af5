"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeflow.llm.common import cut


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected edges (a, b): root is the least node it is connected with.

    Each step is a combining minimum per node and a join with it; the side with one
    row per node lets the join split a hot node. The edges of each round are checkpointed.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = _fingerprint(now)
    while seen[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        now = cut(large.join(lowest, "a").select(F.inline(pairs)).where("a <> b").distinct())
        last, seen = seen, _fingerprint(now)
        if seen == last:
            break
    # All edges now lead from a node to its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
