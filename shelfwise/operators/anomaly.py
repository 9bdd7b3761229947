"""Isolation forest (Liu, Ting, Zhou 2008) over entities (entity, vec)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise
from shelfwise.operators.trees import TreeArrays

TREES = 300
SAMPLE = 256
SEED = 42
DRAWN_AT_ONCE = 4096  #: entities whose draws for all trees are held together
EULER = 0.5772156649015329


def expected_depth(n: int) -> float:
    """Average path length of an unsuccessful search among n entities."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (log(n - 1) + EULER) - 2.0 * (n - 1) / n


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (feature, threshold, left, right, path length) of one random tree."""
    nodes: list[tuple] = []

    def node(rows: np.ndarray, depth: int) -> int:
        place = len(nodes)
        nodes.append((-1, 0.0, 0, 0, depth + expected_depth(len(rows))))
        low, high = rows.min(axis=0), rows.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and varied.size:
            feature = int(rng.choice(varied))
            cut = rng.uniform(low[feature], high[feature])
            below = rows[:, feature] <= cut
            if below.all():  # the draw rounded up to the largest value
                return place
            left = node(rows[below], depth + 1)
            right = node(rows[~below], depth + 1)
            nodes[place] = (feature, cut, left, right, 0.0)
        return place

    node(x, 0)
    return nodes


def draws(entity_hash: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """A reproducible draw for every tree (row) and entity (SplitMix64 finaliser)."""
    z = entity_hash.astype(np.uint64)[None, :] + (
        trees.astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None] * np.uint64(
        0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(1)).astype(np.int64)


def bottom_k(batches: Iterable[pd.DataFrame], size: int, trees: int) -> Iterator[pd.DataFrame]:
    """The ``size`` smallest draws of every tree among all rows (entity, seed, vec) of a task.

    Rows are numbered over the batches and only drawn ones are kept, at most trees x size.
    """
    best = np.zeros((trees, 0), np.int64)  # draws, and the number of the row that drew them
    owner = np.zeros((trees, 0), np.int64)
    rows: dict[int, tuple] = {}
    seen = 0
    for batch in batches:
        for start in range(0, len(batch), DRAWN_AT_ONCE):
            part = batch.iloc[start:start + DRAWN_AT_ONCE]
            new = draws(part["seed"].to_numpy(), np.arange(trees))
            number = np.broadcast_to(seen + np.arange(len(part)), new.shape)
            both, of = np.hstack([best, new]), np.hstack([owner, number])
            if both.shape[1] > size:
                place = np.argpartition(both, size - 1, axis=1)[:, :size]
                both, of = (np.take_along_axis(x, place, axis=1) for x in (both, of))
            best, owner = both, of
            held = np.unique(owner)
            rows = {n: rows[n] for n in held[held < seen].tolist()} | {
                n: (part["entity"].iat[n - seen], part["vec"].iat[n - seen])
                for n in held[held >= seen].tolist()}
            seen += len(part)
    tree, place = np.divmod(np.arange(best.size), max(1, best.shape[1]))
    held = [rows[n] for n in owner.ravel().tolist()]
    yield pd.DataFrame({"tree": tree.astype(np.int32), "_draw": best.ravel(),
                        "entity": [x[0] for x in held], "vec": [x[1] for x in held]})


def _samples(vectors: DataFrame, size: int, trees: int, seed: int) -> DataFrame:
    """``size`` entities per tree without replacement: those with the smallest hash draws.

    Each task finds its own smallest draws of all trees in one pass, so at most
    tasks x trees x size rows are shuffled.
    """
    kind = vectors.schema["vec"].dataType.simpleString()
    drawn = vectors.select("entity", "vec", F.xxhash64(F.lit(seed), "entity").alias("seed")
                           ).mapInPandas(
        lambda batches: bottom_k(batches, size, trees),
        f"tree int, _draw long, entity string, vec {kind}")
    order = F.row_number().over(W.partitionBy("tree").orderBy("_draw", "entity"))
    return drawn.withColumn("_n", order).where(F.col("_n") <= size).select("tree", "_n", "vec")


def isolation_forest(vectors: DataFrame, n_trees: int = TREES, seed: int = SEED) -> DataFrame:
    """Rows (entity, anomaly_score, anomaly_status); above 0.5 is an anomaly.

    Each tree is grown by one task from at most 256 entities. The forest has a bounded number of
    nodes (trees x 511), so it is broadcast and scores every entity in one pass.
    """
    spark = vectors.sparkSession
    vectors = materialise(vectors.select("entity", "vec"))
    n = vectors.count()
    size = min(SAMPLE, n)
    limit = ceil(log2(max(size, 2)))

    def grow(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(sample.sort_values("_n")["vec"].to_numpy())
        nodes = _grow(rows, np.random.default_rng([seed, int(key[0])]), limit)
        return pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "value"]
                            ).assign(tree=int(key[0]), node=range(len(nodes)))

    nodes = _samples(vectors, size, n_trees, seed).groupBy("tree").applyInPandas(
        grow, "feature int, threshold double, left int, right int, value double, tree int, "
              "node int").toPandas()
    width = int(nodes["node"].max()) + 1 if len(nodes) else 1

    def grid(name: str, kind, empty=0):
        table = np.full((n_trees, width), empty, dtype=kind)
        table[nodes["tree"], nodes["node"]] = nodes[name]
        return table

    forest = spark.sparkContext.broadcast(TreeArrays(
        feature=grid("feature", np.int32, -1), threshold=grid("threshold", float),
        left=grid("left", np.int32), right=grid("right", np.int32),
        value=grid("value", float), cover=np.zeros((1, 1))))
    usual = expected_depth(size)

    def score(batches):
        for batch in batches:
            if batch.empty:
                continue
            depth = forest.value.predict(np.stack(batch["vec"].to_numpy())) / n_trees
            ratio = depth / usual if usual else np.ones(len(batch))
            yield pd.DataFrame({"entity": batch["entity"], "anomaly_score": 2.0 ** -ratio})

    return vectors.mapInPandas(score, "entity string, anomaly_score double").withColumn(
        "anomaly_status",
        F.when(F.col("anomaly_score") > 0.5, "ANOMALY").otherwise("NORMAL"))
