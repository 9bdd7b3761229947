"""A fitted tree ensemble as arrays: small enough to broadcast, evaluated batch by batch.

Its size is bounded by the training parameters: trees x 2^(depth + 1) nodes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.storage import new_folder


@dataclass
class TreeArrays:
    """Node tables indexed [tree, node]; ``feature`` is -1 at a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees of the leaf value each row of ``x`` reaches."""
        tree = np.arange(self.feature.shape[0])
        node = np.zeros((x.shape[0], tree.size), dtype=np.int32)
        row = np.arange(x.shape[0])[:, None]
        while True:
            feature = self.feature[tree, node]
            inner = feature >= 0
            if not inner.any():
                return self.value[tree, node].sum(axis=1)
            goes_left = x[row, np.maximum(feature, 0)] <= self.threshold[tree, node]
            child = np.where(goes_left, self.left[tree, node], self.right[tree, node])
            node = np.where(inner, child, node)


def export_trees(spark: SparkSession, model) -> TreeArrays:
    """Read the nodes back from the model's own saved form; leaf values carry the tree weight."""
    path = new_folder(spark, "model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction",
        F.col("nodeData.rawCount").alias("cover"), "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).toPandas()
    trees, width = int(nodes["tree"].max()) + 1, int(nodes["id"].max()) + 1
    at = (nodes["tree"].to_numpy(), nodes["id"].to_numpy())

    def grid(column, kind, empty=0):
        table = np.full((trees, width), empty, dtype=kind)
        table[at] = column
        return table

    weights = np.asarray(model.treeWeights)
    return TreeArrays(
        feature=grid(nodes["feature"], np.int32, -1),
        threshold=grid(nodes["threshold"].fillna(0.0), float),
        left=grid(nodes["leftChild"], np.int32), right=grid(nodes["rightChild"], np.int32),
        value=grid(nodes["prediction"], float) * weights[:, None],
        cover=grid(nodes["cover"], float))
