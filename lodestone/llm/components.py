"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import store


def _sums(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows ``node, label`` for every node of ``edges(a, b)`` but the labels themselves; the label is the component's smallest node.

    Each round hangs neighbours below smaller nodes; rounds go on until the edges are stars, about the logarithm of the
    longest path. Every round is written to the shared folder. An empty edge table gives no rows.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = store(now, name)
    before = _sums(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = store(moved.unionByName(lower.select("a", F.col("m").alias("b"))).distinct(), name)
        after = _sums(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
