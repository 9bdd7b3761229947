"""Mean absolute Shapley value per feature of a tree ensemble.

A leaf pays its value when every feature on its path fits; a feature left out of the coalition
counts with the share of training rows that took its branches (Lundberg et al., path-dependent
values). What a small subtree attributes depends only on which features fit the path down to it
and which of its own cuts a row exceeds. So the values of each such set of bits are worked out once
for all leaves of the subtree, and a row looks them up once for each subtree.
"""

from __future__ import annotations

from dataclasses import fields
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.features import FEATURES
from shelfwise.operators.trees import TreeArrays

TOGETHER = 100_000  #: rows of a task that are attributed at a time
PART = 8000  #: rows that are looked up at a time
TAIL = 2  #: last levels of a tree whose leaves are looked up together


def leaf_games(trees: TreeArrays):
    """Yield per leaf: its value, path features, their (low, high] bounds and branch shares."""
    for t in range(trees.feature.shape[0]):
        stack = [(0, {})]
        while stack:
            node, path = stack.pop()
            feature = int(trees.feature[t, node])
            if feature < 0:
                names = list(path)
                bounds = np.array([path[f] for f in names]).reshape(-1, 3)
                yield trees.value[t, node], names, bounds
                continue
            low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
            cut = trees.threshold[t, node]
            for child, limits in ((trees.left[t, node], (low, min(high, cut))),
                                  (trees.right[t, node], (max(low, cut), high))):
                taken = trees.cover[t, child] / trees.cover[t, node]
                stack.append((int(child), {**path, feature: (*limits, share * taken)}))


def outcome_tables(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley values [leaves, 2^m outcomes, m features]; bit j of an outcome: feature j fits."""
    m = shares.shape[1]
    fits = ((np.arange(2 ** m)[:, None] >> np.arange(m)) & 1).astype(float)
    tables = np.empty((len(values), 2 ** m, m))
    for j in range(m):
        # by_size[..., s]: sum over coalitions of s other features of what the leaf still pays.
        by_size = np.zeros((len(values), 2 ** m, m))
        by_size[:, :, 0] = 1.0
        for other in range(m):
            if other != j:
                joined = by_size[:, :, :-1] * fits[None, :, other, None]
                by_size *= shares[:, other, None, None]
                by_size[:, :, 1:] += joined
        weights = [factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)]
        tables[:, :, j] = values[:, None] * (fits[None, :, j] - shares[:, j, None]) * (
            by_size @ np.array(weights))
    return tables


def base_value(trees: TreeArrays) -> float:
    """Expected prediction: every leaf weighted by its share of training rows."""
    return float(sum(v * np.prod(bounds[:, 2]) for v, _, bounds in leaf_games(trees)))


def leaf_routes(trees: TreeArrays, t: int):
    """Yield per leaf of a tree, in the order of ``leaf_games``, its (node, went right) from above."""
    stack = [(0, [])]
    while stack:
        node, route = stack.pop()
        if trees.feature[t, node] < 0:
            yield route
        else:
            stack += [(int(trees.left[t, node]), [*route, (node, False)]),
                      (int(trees.right[t, node]), [*route, (node, True)])]


class TreeGame:
    """Values of one tree by subtree: all leaves of its ``TAIL`` last levels are looked up at once.

    What a subtree attributes depends on which features fit the path down to it, one bit each, and
    which of its own cuts a row exceeds, one bit each.
    """

    def __init__(self, trees: TreeArrays, t: int, width: int):
        one = TreeArrays(*(getattr(trees, f.name)[t:t + 1] for f in fields(TreeArrays)))
        leaves = [(value, names, bounds, route) for (value, names, bounds), route in zip(
            leaf_games(one), leaf_routes(one, 0), strict=True) if names]
        depth = max((len(route) for *_, route in leaves), default=0)
        feature, cut = one.feature[0], one.threshold[0]
        tables: list = [None] * len(leaves)
        for m in {len(names) for _, names, _, _ in leaves}:
            same = [i for i, leaf in enumerate(leaves) if len(leaf[1]) == m]
            found = outcome_tables(np.array([leaves[i][0] for i in same]),
                                   np.array([leaves[i][2][:, 2] for i in same]))
            for i, table in zip(same, found, strict=True):
                tables[i] = table
        groups: dict[tuple, list[int]] = {}
        for i, (*_, route) in enumerate(leaves):
            groups.setdefault(tuple(route[:max(0, depth - TAIL)]), []).append(i)
        self.pays = []  # for each group [outcome, feature]
        bits: list[tuple] = []  # group, bit, feature, low, high: set where a value is in (low, high]
        for g, (above, members) in enumerate(groups.items()):
            limits: dict[int, tuple] = {}
            for node, right in above:
                low, high = limits.get(feature[node], (-np.inf, np.inf))
                limits[feature[node]] = ((max(low, cut[node]), high) if right
                                         else (low, min(high, cut[node])))
            inner = sorted({n for i in members for n, _ in leaves[i][3][len(above):]})
            on_path, below = list(limits), {n: len(limits) + j for j, n in enumerate(inner)}
            bits += [(g, j, f, *limits[f]) for j, f in enumerate(on_path)]
            bits += [(g, j, feature[n], cut[n], np.inf) for n, j in below.items()]
            outcomes = np.arange(2 ** (len(limits) + len(inner)))
            is_set = [(outcomes >> j & 1).astype(bool) for j in range(len(limits) + len(inner))]
            pays = np.zeros((len(outcomes), width))
            for i in members:
                _, names, _, route = leaves[i]
                fits = {f: is_set[on_path.index(f)] if f in limits else True for f in names}
                for node, right in route[len(above):]:
                    fits[feature[node]] = fits[feature[node]] & (is_set[below[node]] == right)
                own = sum(fits[f].astype(int) << j for j, f in enumerate(names))
                pays[:, names] += tables[i][own]
            self.pays.append(pays)
        # For each feature its cuts and, by the number of them exceeded, the bits of each group.
        self.places = []
        kind = np.min_scalar_type(max((len(pays) for pays in self.pays), default=1))
        for f in sorted({f for _, _, f, _, _ in bits}):
            cuts = np.unique(cut[feature == f])
            lower, upper = np.r_[-np.inf, cuts], np.r_[cuts, np.inf]
            own = np.zeros((len(lower), len(self.pays)), kind)
            for g, j, _, low, high in (b for b in bits if b[2] == f):
                own[(lower >= low) & (upper <= high), g] += 1 << j
            self.places.append((f, cuts, own))

    def add_values(self, columns: np.ndarray, total: np.ndarray) -> None:
        """Add the values of the rows, which ``columns`` holds feature by feature, to ``total``."""
        many = columns.shape[1]
        outcome = 0
        for feature, cuts, bits in self.places:
            place = np.zeros(many, np.intp)
            for cut in cuts:
                place += columns[feature] > cut
            outcome = bits.take(place, axis=0) + outcome
        for g, pays in enumerate(self.pays):
            total += pays.take(outcome[:, g], axis=0)


class Attributor:
    """Shapley values of batches of rows."""

    def __init__(self, trees: TreeArrays, width: int = len(FEATURES)):
        self.games = [TreeGame(trees, t, width) for t in range(trees.feature.shape[0])]

    def values(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros_like(x)
        for start in range(0, len(x), PART):
            part = slice(start, start + PART)
            columns = np.ascontiguousarray(x[part].T)
            for game in self.games:
                game.add_values(columns, total[part])
        return total


def feature_attribution(trees: TreeArrays, rows: DataFrame,
                        features: list[str] = FEATURES) -> DataFrame:
    """Features by falling mean absolute Shapley value over all of ``rows``."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(trees)

    def partial_sums(batches):
        attributor, waiting, many = None, [], 0

        def sums():
            nonlocal attributor
            attributor = attributor or Attributor(shared.value, len(features))
            size = np.abs(attributor.values(np.concatenate(waiting))).sum(axis=0)
            return pd.DataFrame({"feature": features, "size": size, "n": many})

        for batch in batches:
            waiting.append(batch[features].to_numpy(float))
            many += len(batch)
            if many >= TOGETHER:
                yield sums()
                waiting, many = [], 0
        if many:
            yield sums()

    spread = rows.select(*[F.col(f).cast("double").alias(f) for f in features]).repartition(
        spark.sparkContext.defaultParallelism)
    return (
        spread.mapInPandas(partial_sums, "feature string, size double, n long")
        .groupBy("feature").agg((F.sum("size") / F.sum("n")).alias("mean_abs_shap"))
        .orderBy(F.desc("mean_abs_shap"), "feature")
    )
