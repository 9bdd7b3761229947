"""Silhouette, Davies-Bouldin and Calinski-Harabasz for one or many labelings at once.

Input rows are (run, entity, vec, label); ``run`` names the labeling. Label -1 is noise and is
left out. A run gets NULL scores with fewer than two clusters or no more rows than clusters.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.jobs import side_by_side
from shelfwise.functions.ordering import number_rows
from shelfwise.functions.storage import materialise
from shelfwise.operators.pairs import BLOCK, blocks_needed, compare_blocks, distances
from shelfwise.operators.spatial import compare_all


def _clustered(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("label") != -1)


def _sizes(labelled: DataFrame) -> DataFrame:
    """Rows and clusters per run."""
    return labelled.groupBy("run", "label").agg(F.count(F.lit(1)).alias("size")).groupBy(
        "run").agg(F.sum("size").alias("rows"), F.count(F.lit(1)).alias("clusters"))


def _where_defined(score: Column) -> Column:
    return F.when((F.col("clusters") >= 2) & (F.col("rows") > F.col("clusters")), score)


def _all_runs(labelled: DataFrame, scored: DataFrame) -> DataFrame:
    """Runs without any score keep a row with NULL."""
    return labelled.select("run").distinct().join(scored, "run", "left")


def _mean_vector(width: int) -> Column:
    return F.array(*[F.avg(F.col("vec")[i]) for i in range(width)])


def _squared_distance(a: str, b: str) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _width(labelled: DataFrame) -> int:
    first = labelled.select(F.size("vec").alias("n")).first()
    return first["n"] if first else 1


def silhouette(labelled: DataFrame) -> DataFrame:
    """Mean of (b - a) / max(a, b) per run; an entity alone in its cluster counts zero.

    One pass over all unordered pairs of blocks serves all runs and both directions. The work is
    quadratic in the entities, as the measure is by definition.
    """
    points = materialise(_clustered(labelled).select("run", "entity", "vec", "label"))
    sizes = materialise(points.groupBy("run", "label").agg(F.count(F.lit(1)).alias("n")))
    # Distances don't depend on the run: one row per entity with the numbers of its labels, one
    # for each run and label that there is.
    codes = materialise(number_rows(sizes, [F.col("run"), F.col("label")], "code"))
    own = points.join(codes, ["run", "label"])
    entities = materialise(own.groupBy("entity").agg(
        F.first("vec").alias("vec"), F.collect_list(F.col("code").cast("int")).alias("codes")))

    def sums(x: pd.DataFrame, y: pd.DataFrame, same: bool) -> pd.DataFrame:
        apart = distances(x, y)
        sides = [(x, apart, y)] if same else [(x, apart, y), (y, apart.T, x)]
        parts = []
        for one, matrix, others in sides:
            held, code = np.unique(np.concatenate(others["codes"].to_numpy()), return_inverse=True)
            members = np.zeros((len(others), held.size))
            members[np.repeat(np.arange(len(others)), others["codes"].map(len)), code] = 1
            parts.append(pd.DataFrame({
                "entity": one["entity"], "codes": [held.tolist()] * len(one),
                "totals": (matrix @ members).tolist()}))
        return pd.concat(parts)

    blocks = max(1, -(-entities.count() // BLOCK))
    toward = compare_all(entities, blocks, ["entity", "vec", "codes"], sums,
                         "entity string, codes array<int>, totals array<double>")
    toward = toward.select("entity", F.explode(F.arrays_zip("codes", "totals")).alias("t")).groupBy(
        "entity", F.col("t.codes").alias("code")).agg(F.sum("t.totals").alias("total"))
    of = codes.select(F.col("code").cast("int").alias("code"), "run",
                      F.col("label").alias("other"), "n")
    toward = points.select("run", "entity", "label").join(
        toward.join(of, "code"), ["run", "entity"])
    own = F.col("label") == F.col("other")
    per_entity = toward.groupBy("run", "entity").agg(
        F.max(F.when(own, F.col("n"))).alias("mates"),
        F.max(F.when(own, F.col("total"))).alias("own_total"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"))
    a = F.col("own_total") / F.nullif(F.col("mates") - 1, F.lit(0))
    width = F.when(F.col("mates") == 1, 0.0).otherwise(
        F.coalesce((F.col("b") - a) / F.nullif(F.greatest(a, F.col("b")), F.lit(0.0)),
                   F.lit(0.0)))
    scored = per_entity.groupBy("run").agg(F.avg(width).alias("raw")).join(
        _sizes(points), "run").select("run", _where_defined(F.col("raw")).alias("silhouette"))
    return _all_runs(labelled, scored)


def _centroids(points: DataFrame, width: int) -> DataFrame:
    return points.groupBy("run", "label").agg(
        _mean_vector(width).alias("center"), F.count(F.lit(1)).alias("size"))


def davies_bouldin(labelled: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance."""
    points = _clustered(labelled)
    spread = points.join(_centroids(points, _width(labelled)), ["run", "label"]).groupBy(
        "run", "label").agg(
        F.avg(F.sqrt(_squared_distance("vec", "center"))).alias("spread"),
        F.first("center").alias("vec")).withColumn("entity", F.col("label").cast("string"))

    def worst(x: pd.DataFrame, y: pd.DataFrame, *_) -> pd.DataFrame:
        apart = distances(x, y)
        both = x["spread"].to_numpy()[:, None] + y["spread"].to_numpy()[None, :]
        other = x["label"].to_numpy()[:, None] != y["label"].to_numpy()[None, :]
        usable = other & (apart > 0)
        ratio = np.where(usable, both / np.where(usable, apart, 1.0), 0.0)
        return pd.DataFrame({"run": x["run"].iloc[0], "label": x["label"],
                             "worst": ratio.max(axis=1)})

    ratios = compare_blocks(spread, spread, blocks_needed(spread), worst,
                            "run string, label int, worst double")
    scored = ratios.groupBy("run", "label").agg(F.max("worst").alias("worst")).groupBy(
        "run").agg(F.avg("worst").alias("raw")).join(_sizes(points), "run").select(
        "run", _where_defined(F.col("raw")).alias("davies_bouldin"))
    return _all_runs(labelled, scored)


def calinski_harabasz(labelled: DataFrame) -> DataFrame:
    """Between-cluster over within-cluster dispersion, each per degree of freedom."""
    points, width = _clustered(labelled), _width(labelled)
    centers = _centroids(points, width)
    middle = points.groupBy("run").agg(_mean_vector(width).alias("middle"))
    between = centers.join(middle, "run").groupBy("run").agg(
        F.sum(F.col("size") * _squared_distance("center", "middle")).alias("between"),
        F.sum("size").alias("rows"), F.count(F.lit(1)).alias("clusters"))
    within = points.join(centers, ["run", "label"]).groupBy("run").agg(
        F.sum(_squared_distance("vec", "center")).alias("within"))
    score = F.when(F.col("within") == 0, 1.0).otherwise(
        F.col("between") * (F.col("rows") - F.col("clusters"))
        / F.nullif(F.col("within") * (F.col("clusters") - 1), F.lit(0.0)))
    scored = between.join(within, "run").select(
        "run", _where_defined(score).alias("calinski_harabasz"))
    return _all_runs(labelled, scored)


def cluster_scores(labelled: DataFrame) -> DataFrame:
    """The three scores per run, computed at the same time."""
    scores = side_by_side(labelled.sparkSession, lambda score: materialise(score(labelled)),
                          [silhouette, davies_bouldin, calinski_harabasz])
    return scores[0].join(scores[1], "run").join(scores[2], "run")
