"""Supplier disruption: features, scaling, projection, anomaly ranks and the combined table."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, ratio, ratio_or_zero, right_closed, round_to
from shelfwise.functions.ordering import percentile_ranks
from shelfwise.functions.storage import materialise
from shelfwise.operators.anomaly import TREES, isolation_forest
from shelfwise.operators.clustering import (
    INITS, choose_best, compare_clustering, fit_cluster, label_runs, labels_of_choice)
from shelfwise.sources.retail import require_columns

# Fixed feature order of the supplier vectors.
FEATURES = ["average_lead_time", "lead_time_std", "on_time_percentage", "defect_percentage",
            "fill_percentage", "supplier_delay_rate", "demand_mean", "demand_std", "demand_cv",
            "stockout_rate"]
LEVELS = [(40, "LOW"), (60, "MEDIUM"), (80, "HIGH")]


def supplier_features(fact: DataFrame) -> DataFrame:
    """Service, demand and stockout figures per supplier; rates in percent."""
    require_columns(fact, ["supplier", "lead_time_days", "on_time_rate", "defect_rate",
                           "supplier_delay", "ordered_qty", "received_qty", "demand",
                           "stockout"])
    # Rounding removes the summation noise that would split equal rates into different ranks.
    rate = lambda name: F.round(F.avg(name), 12) * 100
    share = lambda name: ratio(F.sum(name), F.count(name))
    deviation = lambda name: F.coalesce(F.stddev_samp(as_double(name)), F.lit(0.0))
    totals = fact.groupBy("supplier").agg(
        share("lead_time_days").alias("average_lead_time"),
        deviation("lead_time_days").alias("lead_time_std"),
        rate("on_time_rate").alias("on_time_percentage"),
        rate("defect_rate").alias("defect_percentage"),
        F.sum("supplier_delay").alias("total_delays"),
        (share("supplier_delay") * 100).alias("supplier_delay_rate"),
        F.sum("ordered_qty").alias("total_ordered"),
        F.sum("received_qty").alias("total_received"),
        share("demand").alias("demand_mean"), deviation("demand").alias("demand_std"),
        (share("stockout") * 100).alias("stockout_rate"),
        F.count(F.lit(1)).alias("observations"))
    return totals.withColumns({
        "fill_percentage": ratio_or_zero("total_received", "total_ordered") * 100,
        "demand_cv": ratio_or_zero("demand_std", "demand_mean"),
    })


def scale_features(df: DataFrame, columns: list[str] = FEATURES, key: str = "supplier"
                   ) -> DataFrame:
    """Key and z-scores with the population deviation; missing is 0, a constant column is 0."""
    usable = lambda c: F.when(
        F.isnan(c) | F.col(c).isNull() | (F.abs(as_double(c)) == float("inf")), 0.0).otherwise(
        as_double(c))
    base = materialise(df.select(key, *[usable(c).alias(c) for c in columns]))
    moments = base.agg(F.struct(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("dev")).alias(c)
        for c in columns])).scalar()

    def scaled(c: str):
        mean, deviation = moments[c]["mean"], moments[c]["dev"]
        # A deviation within rounding noise of the mean is a constant column.
        constant = deviation <= 1e-12 * F.greatest(F.abs(mean), F.lit(1.0))
        return F.when(constant, 0.0).otherwise(
            (F.col(c) - mean) / F.nullif(deviation, F.lit(0.0)))

    return base.select(key, *[scaled(c).alias(c) for c in columns])


def supplier_vectors(features: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Rows (entity, vec) of the scaled features."""
    scaled = scale_features(features, columns)
    return scaled.select(F.col("supplier").alias("entity"), F.array(*columns).alias("vec"))


def pca_2d(vectors: DataFrame) -> DataFrame:
    """Two components of already centred vectors and their shares of the variance.

    A component points so that its largest loading is positive.
    """
    dense = vectors.select("entity", array_to_vector("vec").alias("features"))
    model = PCA(k=2, inputCol="features", outputCol="projected").fit(dense)
    loadings = model.pc.toArray()
    largest = np.abs(loadings).argmax(axis=0)
    signs = [-1.0 if loadings[row, axis] < 0 else 1.0 for axis, row in enumerate(largest)]
    shares = model.explainedVariance.toArray()
    values = vector_to_array("projected")
    return model.transform(dense).select(
        "entity", (values[0] * signs[0]).alias("pc1"), (values[1] * signs[1]).alias("pc2"),
        F.lit(float(shares[0])).alias("explained_variance_pc1"),
        F.lit(float(shares[1])).alias("explained_variance_pc2"))


def disruption_score(features: DataFrame, anomaly_column: str) -> DataFrame:
    """Weighted percentile ranks (higher is worse); the level comes from the rounded score."""
    base = materialise(features)
    ranks = percentile_ranks(base, ["supplier"], {
        "_anomaly": F.col(anomaly_column), "_lead": F.col("average_lead_time"),
        "_late": 100 - F.col("on_time_percentage"), "_unfilled": 100 - F.col("fill_percentage"),
        "_defect": F.col("defect_percentage")})
    score = (
        0.40 * F.col("_anomaly") * 100 + 0.20 * F.col("_lead") * 100 + 0.15 * F.col("_late") * 100
        + 0.15 * F.col("_unfilled") * 100 + 0.10 * F.col("_defect") * 100
    )
    return (
        base.join(ranks, "supplier").withColumn("disruption_score", round_to(score, 2))
        .withColumn("disruption_level", right_closed("disruption_score", LEVELS, "CRITICAL"))
        .drop("_anomaly", "_lead", "_late", "_unfilled", "_defect")
        .orderBy(F.desc("disruption_score"), "supplier")
    )


def disruption_detection(fact: DataFrame, n_init: int = INITS, n_trees: int = TREES,
                         order: str = "best", comparison: DataFrame | None = None,
                         labelled: DataFrame | None = None) -> dict[str, DataFrame]:
    """The supplier table, the model comparison and the projection.

    ``order`` is how the clustering model is chosen, see ``choose_best``. The clusters are those
    of the run that was scored; only a choice that was not among the runs is fitted. The runs'
    labels and their comparison, made before on the same fact, may be handed in.
    """
    features = materialise(supplier_features(fact))
    vectors = materialise(supplier_vectors(features))
    if labelled is None:
        labelled = label_runs(vectors, n_init)
    if comparison is None:
        comparison = materialise(compare_clustering(vectors, n_init, labelled))
    choice = choose_best(comparison, order).first()  # one row
    clusters = materialise(labels_of_choice(labelled, choice["model"], choice["parameter"]))
    if clusters.isEmpty():
        clusters = materialise(fit_cluster(vectors, choice["model"], choice["parameter"], n_init))
    named = clusters.select(F.col("entity").alias("supplier"), F.col("label").alias("cluster"))
    anomalies = isolation_forest(vectors, n_trees).withColumnRenamed("entity", "supplier")
    joined = features.join(named, "supplier").join(anomalies, "supplier")
    table = disruption_score(joined, "anomaly_score").withColumns({
        "cluster_model": F.lit(choice["model"]),
        "cluster_parameter": F.lit(float(choice["parameter"]))})
    projection = pca_2d(vectors).withColumnRenamed("entity", "supplier").join(named, "supplier")
    return {"disruption_detection": table, "disruption_model_comparison": comparison,
            "disruption_pca": projection}
