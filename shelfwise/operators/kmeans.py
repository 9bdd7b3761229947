"""K-means for many (k, start) runs at once: every pass over the entities serves all runs.

A sweep of seven k with twenty starts is 140 models. Fitted one by one, each of them scans the
data once per step. Here one scan per step assigns every entity in every unfinished run; only
sums per (run, cluster) come back, and the centers (runs x k rows) are all the driver holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise

MAX_STEPS = 300
STARTS = 1 << 20  # more than any number of starts: runs are numbered by k and start
TOLERANCE = 1e-4


def _uniform(entity_hash: np.ndarray, run: int, turn: int) -> np.ndarray:
    """Reproducible draws in (0, 1) per entity, run and turn (SplitMix64 finaliser)."""
    z = entity_hash.astype(np.uint64) + np.uint64(run * 2 + 1) * np.uint64(0x9E3779B97F4A7C15)
    z = z + np.uint64(turn * 2 + 1) * np.uint64(0xD1B54A32D192ED03)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    return (z.astype(float) + 0.5) / 2.0 ** 64


def _squared(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centers[None, :, :]) ** 2).sum(axis=2)


def _start_centers(points: DataFrame, ks: dict[int, int]) -> dict[int, np.ndarray]:
    """k-means++ for every run: an entity is drawn with weight of its squared distance.

    The draw is a race: the smallest exponential time -ln(u) / weight wins, so the winner over
    all partitions is one aggregate.
    """
    spark = points.sparkSession
    centers: dict[int, np.ndarray] = {}
    for turn in range(max(ks.values())):
        racing = [run for run, k in ks.items() if k > turn]
        shared = spark.sparkContext.broadcast(dict(centers))

        def race(batches):
            for batch in batches:
                if batch.empty:
                    continue
                x, seeds = np.stack(batch["vec"].to_numpy()), batch["seed"].to_numpy()
                best, when = [], []
                for run in racing:
                    known = shared.value.get(run)
                    weight = (np.ones(len(x)) if known is None
                              else _squared(x, known).min(axis=1))
                    with np.errstate(divide="ignore"):
                        time = -np.log(_uniform(seeds, run, turn)) / weight
                    best.append(int(time.argmin()))
                    when.append(float(time.min()))
                yield pd.DataFrame({"run": racing, "time": when,
                                    "vec": [x[i].tolist() for i in best]})

        won = points.mapInPandas(race, "run int, time double, vec array<double>").groupBy(
            "run").agg(F.min_by("vec", "time").alias("vec")).collect()  # one row per run
        for row in won:
            drawn = np.array([row["vec"]])
            old = centers.get(row["run"])
            centers[row["run"]] = drawn if old is None else np.vstack([old, drawn])
        shared.destroy()
    return centers


def _step(points: DataFrame, centers: dict[int, np.ndarray]) -> dict[int, list]:
    """Sums per (run, cluster) for the given centers: (cluster, n, total vector, cost)."""
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast(centers)

    def assign(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["vec"].to_numpy())
            rows = []
            for run, known in shared.value.items():
                apart = _squared(x, known)
                label = apart.argmin(axis=1)
                cost = apart[np.arange(len(x)), label]
                for cluster in np.unique(label):
                    own = label == cluster
                    rows.append((run, int(cluster), int(own.sum()), x[own].sum(axis=0).tolist(),
                                 float(cost[own].sum())))
            yield pd.DataFrame(rows, columns=["run", "cluster", "n", "total", "cost"])

    width = next(iter(centers.values())).shape[1]
    sums = points.mapInPandas(
        assign, "run int, cluster int, n long, total array<double>, cost double"
    ).groupBy("run", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"),
        F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total"))
    found: dict[int, list] = {}
    for row in sums.collect():  # runs x k rows
        found.setdefault(row["run"], []).append(
            (row["cluster"], row["n"], np.array(row["total"]), row["cost"]))
    shared.destroy()
    return found


def fit_centers(vectors: DataFrame, ks: list[int], n_init: int, seed: int,
                max_steps: int = MAX_STEPS) -> dict[int, np.ndarray]:
    """Centers of the cheapest of ``n_init`` runs for each k.

    A run's draws follow from its k and its start alone, so a k gets the same centers in any sweep.
    Raises if a run still moves after ``max_steps``.
    """
    points = materialise(vectors.select("vec", F.xxhash64(F.lit(seed), "entity").alias("seed")))
    runs = {k * STARTS + start: k for k in ks for start in range(n_init)}
    spread = points.agg(*[F.var_pop(F.col("vec")[i]) for i in range(
        len(points.select("vec").first()["vec"]))]).first()
    enough = TOLERANCE * float(np.mean(spread))
    centers, cost = _start_centers(points, runs), {}
    moving = dict(centers)
    for _ in range(max_steps):
        for run, sums in _step(points, moving).items():
            cost[run] = sum(s[3] for s in sums)
            new = centers[run].copy()  # an empty cluster stays where it is
            for cluster, n, total, _ in sums:
                new[cluster] = total / n
            moved = float(((new - centers[run]) ** 2).sum())
            centers[run] = new
            if moved <= enough:
                del moving[run]
            else:
                moving[run] = new
        if not moving:
            break
    else:
        raise RuntimeError(f"k-means: {len(moving)} runs still move after {max_steps} steps")
    final = _step(points, centers)
    cost = {run: sum(s[3] for s in sums) for run, sums in final.items()}
    return {k: centers[min((r for r, rk in runs.items() if rk == k), key=lambda r: (cost[r], r))]
            for k in ks}


def assign_labels(vectors: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """Rows (run, entity, label) for each k, from one pass."""
    shared = vectors.sparkSession.sparkContext.broadcast(centers)

    def label(batches):
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch["vec"].to_numpy())
            for k, known in shared.value.items():
                yield pd.DataFrame({"run": f"k={k}", "entity": batch["entity"],
                                    "label": _squared(x, known).argmin(axis=1)})

    return vectors.select("entity", "vec").mapInPandas(
        label, "run string, entity string, label int")
