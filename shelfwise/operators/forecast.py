"""Forecast metrics, naive baselines, boosted trees and the recursive 30-day forecast."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, ratio_or_zero, round_to
from shelfwise.functions.jobs import side_by_side
from shelfwise.functions.storage import materialise, shared_dir
from shelfwise.operators.features import (
    FEATURES, HOLD_OUT_DAYS, NETWORK_FEATURES, SERIES, demand_lags, temporal_split,
    walk_forward_folds)

# Fixed model names that the validation rules look for.
NAIVE = "SKU Naive-1-Day"
SEASONAL_NAIVE = "SKU Seasonal-Naive-7-Day"
BOOSTED = "SKU-Store Boosted Trees"
HORIZON = 30
RECENT = 30
TASK_ROWS = 20_000  #: training rows of a task at least


@dataclass(frozen=True)
class BoostParams:
    trees: int = 400
    learning_rate: float = 0.05
    depth: int = 6
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42


def _error_sums(actual: str, predicted: str) -> dict[str, Column]:
    """Sums from which MAE, RMSE and MAPE follow; they add up over partial groups."""
    error = as_double(actual) - as_double(predicted)
    nonzero = F.col(actual) != 0
    return {
        "n": F.count(error), "abs": F.sum(F.abs(error)), "sq": F.sum(error * error),
        "pct": F.sum(F.when(nonzero, F.abs(error / F.nullif(as_double(actual), F.lit(0.0))))),
        "pct_n": F.count(F.when(nonzero, error)),
    }


def _metrics(prefix: str = "") -> dict[str, Column]:
    total = lambda name: F.col(f"{prefix}{name}")
    return {
        "MAE": total("abs") / F.nullif(total("n"), F.lit(0)),
        "RMSE": F.sqrt(total("sq") / F.nullif(total("n"), F.lit(0))),
        "MAPE": 100.0 * ratio_or_zero(total("pct"), total("pct_n")),
    }


def forecast_metrics(df: DataFrame, actual: str, predicted: str, model: str) -> DataFrame:
    """One row: MAE, RMSE and MAPE (zero actuals left out) of a prediction column."""
    sums = df.agg(*[c.alias(n) for n, c in _error_sums(actual, predicted).items()])
    return sums.select(F.lit(model).alias("model"),
                       *[c.alias(n) for n, c in _metrics().items()])


def naive_baselines(daily: DataFrame, days: int = HOLD_OUT_DAYS) -> DataFrame:
    """Last-row and seven-rows-back forecasts scored on the last ``days``.

    Errors are summed per pair first, which also gives the pair count without a second pass.
    """
    data = temporal_split(demand_lags(daily, (1, 7)).dropna(), days)
    in_test = lambda name: F.when(F.col("split") == "test", F.col(name))
    scored = data.select(*SERIES, in_test("demand").alias("demand"),
                         in_test("lag_1").alias("lag_1"), in_test("lag_7").alias("lag_7"))
    models = {"a_": ("lag_1", NAIVE), "b_": ("lag_7", SEASONAL_NAIVE)}
    partial = [c.alias(f"{p}{n}") for p, (lag, _) in models.items()
               for n, c in _error_sums("demand", lag).items()]
    names = [f"{p}{n}" for p in models for n in _error_sums("demand", "lag_1")]
    total = scored.groupBy(*SERIES).agg(*partial).agg(
        *[F.sum(n).alias(n) for n in names], F.count(F.lit(1)).alias("sku_store_pairs"))
    rows = F.array(*[
        F.struct(F.lit(label).alias("model"), *[c.alias(n) for n, c in _metrics(p).items()])
        for p, (_, label) in models.items()])
    return total.select(F.explode(rows).alias("m"), "sku_store_pairs").select(
        "m.*", "sku_store_pairs")


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


def fit_boosted(train: DataFrame, params: BoostParams = BoostParams(),
                features: list[str] = FEATURES):
    """Boosted regression trees on demand; row and column sampling as given.

    Residuals are checkpointed into the shared folder every ten trees, so the plan stays short. Each
    level of each tree is a job, so short series go to few tasks (``TASK_ROWS`` rows each).
    """
    shared_dir(train.sparkSession)
    train = train.coalesce(max(1, -(-train.count() // TASK_ROWS)))
    learner = GBTRegressor(
        featuresCol="features", labelCol="demand", predictionCol="prediction",
        maxIter=params.trees, stepSize=params.learning_rate, maxDepth=params.depth,
        subsamplingRate=params.row_share, featureSubsetStrategy=str(params.column_share),
        seed=params.seed, checkpointInterval=10)
    return learner.fit(_assembled(train, features).select("features", "demand"))


def predict_demand(model, df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Add ``predicted_demand``, never below zero."""
    return (
        model.transform(_assembled(df, features))
        .withColumn("predicted_demand", F.greatest(F.col("prediction"), F.lit(0.0)))
        .drop("features", "prediction")
    )


def boosted_forecast(model, train: DataFrame, test: DataFrame, name: str = BOOSTED) -> DataFrame:
    """One row: hold-out errors with the row counts and the pairs covered."""
    pairs = (
        train.select(*SERIES, F.lit(0).alias("is_test"))
        .unionByName(test.select(*SERIES, F.lit(1).alias("is_test")))
        .groupBy(*SERIES).agg(F.sum("is_test").alias("test"), F.count(F.lit(1)).alias("all"))
    )
    sizes = pairs.agg(
        F.struct(F.sum(F.col("all") - F.col("test")).alias("train"), F.sum("test").alias("test"),
                 F.count(F.lit(1)).alias("pairs"))).scalar()
    errors = forecast_metrics(predict_demand(model, test), "demand", "predicted_demand", name)
    return errors.select(
        "model", sizes["train"].alias("train_rows"), sizes["test"].alias("test_rows"),
        "MAE", "RMSE", "MAPE", sizes["pairs"].alias("sku_store_pairs"))


def test_predictions(model, test: DataFrame) -> DataFrame:
    return predict_demand(model, test).select(
        "date", *SERIES, "category", "demand", "predicted_demand")


class SeasonalNaive:
    """A model for the recursion that repeats the demand seven days before."""

    def predict(self, x: np.ndarray) -> np.ndarray:
        return x[:, FEATURES.index("lag_7")]


def _step_features(recent: np.ndarray, days: pd.DatetimeIndex) -> np.ndarray:
    """Feature rows for the next day of every series; promotion and discount are zero."""
    week = recent[:, -7:]
    weekday = days.dayofweek.to_numpy()
    nothing = np.zeros(len(recent))
    return np.column_stack([
        recent[:, -1], recent[:, -7], recent[:, -14], recent[:, -30],
        week.mean(axis=1), recent[:, -30:].mean(axis=1), week.std(axis=1, ddof=1),
        weekday, days.month, days.day, weekday >= 5, nothing, nothing]).astype(float)


def recursive_forecast(predictor, daily: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Forecast every series day by day, each prediction feeding the later lags.

    A series needs only its last 30 values, and no series needs another. So the table is cut to
    one row per series and the whole recursion runs inside one stage, all series of an Arrow
    batch at once; ``predictor`` (arrays of bounded size) is broadcast.
    """
    spark = daily.sparkSession
    newest = W.partitionBy(*SERIES).orderBy(F.desc("date"))
    series = (
        daily.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") <= RECENT)
        .groupBy(*SERIES)
        .agg(F.array_sort(F.collect_list(F.struct("date", as_double("demand").alias("d")))
                          ).alias("tail"),
             F.max("date").alias("last_date"),
             F.max_by("category", "date").alias("category"),
             F.max_by(as_double("unit_price"), "date").alias("unit_price"))
        .where(F.size("tail") == RECENT)
        .select(*SERIES, "category", "unit_price", "last_date",
                F.col("tail.d").alias("recent"))
    )
    shared = spark.sparkContext.broadcast(predictor)

    def forward(batches):
        for batch in batches:
            if batch.empty:
                continue
            history = np.array(batch["recent"].tolist(), dtype=float)
            last = pd.DatetimeIndex(pd.to_datetime(batch["last_date"]))
            for ahead in range(1, horizon + 1):
                days = last + pd.Timedelta(days=ahead)
                recent = history[:, -RECENT:]
                demand = np.maximum(shared.value.predict(_step_features(recent, days)), 0.0)
                history = np.column_stack([history, demand])
                yield pd.DataFrame({
                    "date": days.date, "store": batch["store"], "product": batch["product"],
                    "category": batch["category"], "forecast_demand": demand,
                    "unit_price": batch["unit_price"]})

    schema = ("date date, store string, product string, category string, "
              "forecast_demand double, unit_price double")
    return series.mapInPandas(forward, schema).withColumn(
        "forecast_demand", round_to("forecast_demand", 2))


def walk_forward_validation(data: DataFrame, params: BoostParams = BoostParams(trees=300),
                            n_folds: int = 4) -> DataFrame:
    """Fit and score each expanding fold of the network series; last row is the mean."""
    folds = materialise(walk_forward_folds(data.dropna(), n_folds))

    def score(fold: int) -> DataFrame:
        part = folds.where(F.col("fold") == fold)
        train, test = (part.where(F.col("role") == role) for role in ("train", "test"))
        model = fit_boosted(train, params, NETWORK_FEATURES)
        rows = lambda role: F.count_if(F.col("role") == role).alias(f"{role}_rows")
        sizes = part.agg(F.struct(rows("train"), rows("test"))).scalar()
        errors = forecast_metrics(predict_demand(model, test, NETWORK_FEATURES),
                                  "demand", "predicted_demand", BOOSTED)
        return errors.select(
            F.lit(str(fold)).alias("fold"), sizes["train_rows"].alias("train_rows"),
            sizes["test_rows"].alias("test_rows"), "MAE", "RMSE", "MAPE")

    # The folds are independent and small (one row per day), so they are fitted side by side.
    present = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]
    scored = side_by_side(folds.sparkSession, score, present)
    result = reduce(DataFrame.unionByName, scored)
    result = materialise(result)
    mean = result.agg(*[F.avg(m).alias(m) for m in ("MAE", "RMSE", "MAPE")]).select(
        F.lit("mean").alias("fold"), F.lit(None).cast("long").alias("train_rows"),
        F.lit(None).cast("long").alias("test_rows"), "MAE", "RMSE", "MAPE")
    return result.unionByName(mean)
