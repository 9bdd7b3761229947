"""Connected components by alternating large and small stars, every round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.storage import discard, materialise


def _larger_first(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                        F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` of every node of ``edges`` (columns ``a``, ``b`` of one type).

    The root is the smallest node that can be reached. Each round links every node's larger
    neighbours, then its smaller ones, to the smallest among them; the smallest is found by
    partial aggregation, so a node with very many edges doesn't gather them in one task. Raises if
    ``max_rounds`` don't suffice (they grow with the logarithm of the longest path).
    """
    edges = materialise(_larger_first(edges))
    state = _state(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"),
                                                          F.col("m").alias("b"))
        large = materialise(_larger_first(large))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            low.select("a", F.col("m").alias("b")))
        done, edges = (edges, large), materialise(_larger_first(small))
        discard(*done)
        before, state = state, _state(edges)
        if state == before:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(roots.select("root", "root").distinct())
    raise RuntimeError(f"components: not settled after {max_rounds} rounds")
