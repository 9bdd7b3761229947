"""The whole chain from the daily fact to validated result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shelfwise.functions.jobs import side_by_side
from shelfwise.functions.storage import shared_dir
from shelfwise.operators import (
    actions, attribution, disruption, features, finance, forecast, inventory, supplier, temporal,
    validation)
from shelfwise.operators.trees import export_trees
from shelfwise.sources.retail import write_artifact


def run_pipeline(fact: DataFrame, out_dir: str,
                 params: forecast.BoostParams = forecast.BoostParams(),
                 n_init: int = 20, n_trees: int = 300, order: str = "best",
                 check: bool = True, model=None, comparison: DataFrame | Callable | None = None,
                 labelled: DataFrame | Callable | None = None,
                 attributed: DataFrame | Callable | None = None) -> dict[str, DataFrame]:
    """Compute, write and read back every result table, then check the rules.

    Each table is written once and later steps scan the written form. With ``check`` a broken
    rule raises; the expected pair count is that of the fact. A model already fitted on the
    training rows, its attribution, and clustering labels and their comparison, may be handed in,
    also as functions that give them.

    Fitting the trees is thousands of short jobs that leave cores idle. So what needs no model, the
    disruption tables and the other tables of the fact, is computed at the same time.
    """
    spark = fact.sparkSession
    shared_dir(spark)
    tables: dict[str, DataFrame] = {}

    def keep(name: str, table: DataFrame) -> DataFrame:
        path = f"{out_dir}/{name}"
        write_artifact(table, path)
        tables[name] = spark.read.schema(table.schema).parquet(path)
        return tables[name]

    def at_once(*branches: Callable[[], None]) -> None:
        side_by_side(spark, lambda branch: branch(), branches)

    def given(value):
        return value() if callable(value) else value

    daily = keep("daily_drivers", features.daily_demand_drivers(fact))
    training = keep("training_set", features.forecast_training_set(daily))
    train, test = features.train_and_test(training)

    def by_model() -> None:
        fitted = given(model) or forecast.fit_boosted(train, params)
        trees = export_trees(spark, fitted)

        def scored() -> None:
            keep("boosted_results", forecast.boosted_forecast(fitted, train, test))
            keep("test_predictions", forecast.test_predictions(fitted, test))

        def planned() -> None:
            ahead = keep("sku_30_day_forecast", forecast.recursive_forecast(trees, daily))
            stock = keep("inventory_optimization", inventory.inventory_optimization(fact, ahead))
            risk = keep("supplier_risk", supplier.supplier_risk(fact))
            keep("action_priorities", actions.action_priorities(stock, risk, ahead))
            keep("business_impact", actions.business_impact(fact, stock))

        def explained() -> None:
            own = given(attributed)
            keep("feature_attribution", own if own is not None
                 else attribution.feature_attribution(trees, train))

        at_once(scored, planned, explained)

    def disrupted() -> None:
        found = disruption.disruption_detection(
            fact, n_init, n_trees, order, given(comparison), given(labelled))
        for name, table in found.items():
            keep(name, table)

    def of_fact() -> None:
        keep("baseline_results", forecast.naive_baselines(daily))
        keep("temporal_disruption", temporal.temporal_disruption(fact))
        for table in (finance.finance_summary, finance.budget_vs_actual,
                      finance.promotion_effectiveness, finance.abc_analysis,
                      finance.supplier_stockout_impact):
            keep(table.__name__, table(fact))

    at_once(by_model, disrupted, of_fact)
    pairs = features.pair_coverage(fact).first()["sku_store_pairs"]
    report = keep("validation_report", validation.validation_report(spark, tables, pairs))
    if check:
        validation.require_valid(report)
    return tables
