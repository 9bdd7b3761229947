"""All-pairs work on entities without a row per pair.

Entities are hashed into blocks of about ``BLOCK`` rows. Each pair of blocks is one co-group of
bounded size, compared as matrices, and only reduced results leave it: a number per entity (or
per cluster), never the pairs. Work is quadratic in the entities, as the measures are by
definition, but spread evenly over all tasks, and no entity or dense group is cut off.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 512


def distances(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """Euclidean distance of every left row to every right row, exactly symmetric."""
    a, b = np.stack(left["vec"].to_numpy()), np.stack(right["vec"].to_numpy())
    total = np.zeros((len(a), len(b)))
    for axis in range(a.shape[1]):
        total += (a[:, axis, None] - b[None, :, axis]) ** 2
    return np.sqrt(total)


def blocks_needed(df: DataFrame) -> int:
    """Number of blocks per run so that a block holds about ``BLOCK`` rows."""
    largest = df.groupBy("run").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return max(1, -(-largest // BLOCK))


def compare_blocks(left: DataFrame, right: DataFrame, blocks: int,
                   reduce_pair: Callable[[pd.DataFrame, pd.DataFrame, int, int], pd.DataFrame],
                   schema: str, key: Column | None = None) -> DataFrame:
    """Apply ``reduce_pair`` to every ordered pair of blocks within a run.

    Both sides have columns ``run`` and ``vec``; ``key`` decides the block (default: entity).
    """
    own = F.pmod(F.xxhash64("entity") if key is None else key, F.lit(blocks)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    a = left.withColumn("_a", own).withColumn("_b", others)
    # Fresh aliases: both sides may stem from the same table.
    b = right.withColumn("_b", own).withColumn("_a", others).select(
        *[F.col(c).alias(c) for c in [*right.columns, "_a", "_b"]])

    def pair(keys: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame()
        return reduce_pair(x, y, int(keys[1]), int(keys[2]))

    group = ["run", "_a", "_b"]
    return a.groupBy(*group).cogroup(b.groupBy(*group)).applyInPandas(pair, schema)
