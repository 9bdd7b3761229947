"""Spatial blocks of entities, and work on pairs of blocks that are near each other.

Range splits on a bounded sample cut the space into cells; a cell with more than ``BLOCK`` entities
(many copies, or more entities than ``MAX_CELLS`` cells hold) is dealt into several blocks. A pair
of cells is compared only if the bounding boxes of what they really hold are within the radius, so
the choice of splits never changes a result. Every unordered pair of blocks is one group with both
blocks in it: a vector is sent once to each near block, and one matrix serves both directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise
from shelfwise.operators.pairs import BLOCK

MAX_CELLS = 1024
SAMPLED = 64  #: entities for each cell
PIECES = 1 << 32  #: numbers of blocks for each cell


class Splits(NamedTuple):
    """A full binary tree: node i cuts its axis at a value; its children are 2i + 1 and 2i + 2."""

    depth: int
    axis: np.ndarray
    value: np.ndarray

    def cells(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            right = x[np.arange(len(x)), self.axis[node]] > self.value[node]
            node = 2 * node + 1 + right
        return node - ((1 << self.depth) - 1)


def range_splits(sample: np.ndarray, cells: int) -> Splits:
    """Median cuts of the widest axis, halving the sample until there are ``cells`` parts."""
    depth = max(0, (cells - 1).bit_length())
    axis, value = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    parts = {0: sample}
    for node in range((1 << depth) - 1):
        own = parts.pop(node)
        if len(own):
            axis[node] = int((own.max(axis=0) - own.min(axis=0)).argmax())
            column = own[:, axis[node]]
            value[node] = np.median(column)
            if value[node] == column.max():  # keep ties together, on the smaller side
                lower = column[column < value[node]]
                value[node] = lower.max() if len(lower) else value[node]
        right = own[:, axis[node]] > value[node] if len(own) else np.zeros(0, bool)
        parts[2 * node + 1], parts[2 * node + 2] = own[~right], own[right]
    return Splits(depth, axis, value)


def spatial_blocks(points: DataFrame, rows: int = BLOCK, max_cells: int = MAX_CELLS) -> DataFrame:
    """``points`` (entity, vec, ...) with ``cell`` and ``block``, written once.

    A block has about ``rows`` entities. The driver holds ``SAMPLED`` vectors for each cell.
    """
    many = points.count()
    cells = min(max_cells, -(-many // rows))
    if cells <= 1 and many <= rows:
        return materialise(points.withColumns({"cell": F.lit(0).cast("long"),
                                               "block": F.lit(0).cast("long")}))
    sample = points.select("vec").orderBy(F.xxhash64("entity")).limit(SAMPLED * cells).collect()
    splits = points.sparkSession.sparkContext.broadcast(
        range_splits(np.array([row["vec"] for row in sample]), cells))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["vec"].to_numpy()) if len(batch) else np.zeros((0, 1))
            yield batch.assign(cell=splits.value.cells(x))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    placed = materialise(points.mapInPandas(assign, f"{kinds}, cell long"))
    pieces = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / rows).alias("_pieces"))
    piece = F.pmod(F.xxhash64("entity"), F.col("_pieces"))
    return materialise(placed.join(F.broadcast(pieces), "cell").withColumn(  # max_cells rows
        "block", F.col("cell") * F.lit(PIECES) + piece).drop("_pieces"))


def near_pairs(placed: DataFrame, radius: float) -> DataFrame:
    """``block, a, b``: both blocks of every pair (a <= b) whose cells' boxes are within a radius."""
    width = len(placed.select("vec").first()["vec"])
    boxes = placed.groupBy("cell").agg(
        *[f(F.col("vec")[i]).alias(f"{name}{i}") for i in range(width)
          for name, f in (("low", F.min), ("high", F.max))]).orderBy("cell").toPandas()
    low, high = (boxes[[f"{name}{i}" for i in range(width)]].to_numpy() for name in ("low", "high"))
    cells, pairs = boxes["cell"].to_numpy(), []
    for i in range(len(cells)):  # at most MAX_CELLS
        gap = np.maximum(0, np.maximum(low[i] - high[i:], low[i:] - high[i]))
        near = np.flatnonzero(np.sqrt((gap ** 2).sum(axis=1)) <= radius * (1 + 1e-9))
        pairs.append(np.stack([np.full(len(near), cells[i]), cells[i + near]], 1))
    spark = placed.sparkSession
    table = spark.createDataFrame(pd.DataFrame(np.concatenate(pairs), columns=["x", "y"]))
    blocks = placed.select("cell", "block").distinct()
    a = blocks.select(F.col("cell").alias("x"), F.col("block").alias("a"))
    b = blocks.select(F.col("cell").alias("y"), F.col("block").alias("b"))
    both = table.join(a, "x").join(b, "y").where("a <= b or x < y").select("a", "b")
    return both.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("block"), "a", "b")


def compare_near(placed: DataFrame, pairs: DataFrame, columns: list[str],
                 reduce_pair: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame],
                 schema: str) -> DataFrame:
    """Apply ``reduce_pair(x, y, same)`` to each pair of near blocks; ``same``: x and y are one."""
    sent = placed.select("block", *columns).join(pairs, "block")
    return _by_pair(sent, columns, reduce_pair, schema)


def compare_all(points: DataFrame, blocks: int, columns: list[str],
                reduce_pair: Callable[[pd.DataFrame, pd.DataFrame, bool], pd.DataFrame],
                schema: str) -> DataFrame:
    """``compare_near`` for all pairs of ``blocks`` blocks of hashed entities."""
    block = F.pmod(F.xxhash64("entity"), F.lit(blocks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    sent = points.select(block.alias("block"), *columns).withColumn("other", other).select(
        "block", *columns, F.least("block", "other").alias("a"),
        F.greatest("block", "other").alias("b"))
    return _by_pair(sent, columns, reduce_pair, schema)


def _by_pair(sent: DataFrame, columns: list[str], reduce_pair: Callable, schema: str) -> DataFrame:
    def pair(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        a, b = keys
        if a == b:
            return reduce_pair(rows, rows, True)
        first = rows["block"].to_numpy() == a
        if first.all() or not first.any():
            return pd.DataFrame()
        return reduce_pair(rows[first], rows[~first], False)

    return sent.groupBy("a", "b").applyInPandas(pair, schema)
