"""What several queries share on one input folder, each prepared once per Spark application."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from shelfwise.functions.jobs import ship_package
from shelfwise.functions.storage import materialise, new_folder, write_and_read
from shelfwise.operators import (
    actions, attribution, clustering, disruption, etl, features, forecast, inventory, supplier)
from shelfwise.plans.pipeline import run_pipeline
from shelfwise.operators.trees import TreeArrays, export_trees
from shelfwise.sources.testdata import daily_fact_from_orders

# The documented models: 400 trees on all pairs, 300 for each fold of the network series.
QUERY_PARAMS = forecast.BoostParams(trees=400)
FOLD_PARAMS = forecast.BoostParams(trees=300)
QUERY_INITS = 20


class Workspace:
    """The daily fact and the star tables, written once as parquet and scanned from there."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def fact(self) -> DataFrame:
        return write_and_read(daily_fact_from_orders(self.spark, self.folder), "daily-fact")

    @cached_property
    def star(self) -> etl.Star:
        return etl.reload_star(self.fact, new_folder(self.spark, "star"))

    @cached_property
    def drivers(self) -> DataFrame:
        """Daily demand with its drivers, one row per pair and day."""
        return write_and_read(features.daily_demand_drivers(self.fact), "daily-drivers")

    @cached_property
    def training_set(self) -> DataFrame:
        return write_and_read(features.forecast_training_set(self.drivers), "training-set")

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return features.train_and_test(self.training_set)

    @cached_property
    def model(self):
        return forecast.fit_boosted(self.split[0], QUERY_PARAMS)

    @cached_property
    def trees(self) -> TreeArrays:
        return export_trees(self.spark, self.model)

    @cached_property
    def attribution(self) -> DataFrame:
        return materialise(attribution.feature_attribution(self.trees, self.split[0]))

    @cached_property
    def network(self) -> DataFrame:
        """Network features, one row per day with a full history."""
        daily = features.network_daily_demand(self.fact)
        return materialise(features.demand_features(daily, keys=()).dropna())

    @cached_property
    def naive_forecast(self) -> DataFrame:
        return write_and_read(
            forecast.recursive_forecast(forecast.SeasonalNaive(), self.drivers), "naive-forecast")

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock policy on the seasonal-naive forecast, which needs no fitted model."""
        return write_and_read(
            inventory.inventory_optimization(self.fact, self.naive_forecast), "inventory")

    @cached_property
    def fallback_inventory(self) -> DataFrame:
        """Stock policy without any forecast."""
        return write_and_read(inventory.inventory_optimization(self.fact), "inventory-fallback")

    @cached_property
    def risk(self) -> DataFrame:
        return write_and_read(supplier.supplier_risk(self.fact), "supplier-risk")

    @cached_property
    def actions(self) -> DataFrame:
        return write_and_read(actions.action_priorities(
            self.inventory, self.risk, self.naive_forecast), "actions")

    @cached_property
    def vectors(self) -> DataFrame:
        """Scaled supplier vectors (entity, vec)."""
        return materialise(disruption.supplier_vectors(disruption.supplier_features(self.fact)))

    @cached_property
    def comparison(self) -> DataFrame:
        return materialise(clustering.compare_clustering(self.vectors, QUERY_INITS, self.labelled))

    @cached_property
    def labelled(self) -> DataFrame:
        """Labels of every compared clustering run."""
        return clustering.label_runs(self.vectors, QUERY_INITS)

    @cached_property
    def results(self) -> dict[str, DataFrame]:
        """Every result table of the whole chain, with the one fitted model.

        The model and the clusterings are made at the same time, each in one thread; what both
        need is there before.
        """
        _ = self.split, self.vectors
        return run_pipeline(self.fact, new_folder(self.spark, "results"), QUERY_PARAMS,
                            QUERY_INITS, check=False, model=lambda: self.model,
                            comparison=lambda: self.comparison, labelled=lambda: self.labelled,
                            attributed=lambda: self.attribution)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        ship_package(spark)
        _open[key] = Workspace(spark, folder)
    return _open[key]
