"""Every operator as a query over one input folder: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.numeric import round_to
from shelfwise.functions.ordering import pct_rank
from shelfwise.functions.storage import materialise, new_folder
from shelfwise.operators import (
    actions, anomaly, attribution, business, cluster_scores, clustering, disruption, etl, features,
    finance, finance_star, forecast, inventory, quality, supplier, temporal, validation, views)
from shelfwise.plans.workspace import FOLD_PARAMS, QUERY_PARAMS, Workspace, workspace
from shelfwise.sources import retail
from shelfwise.sources.schema import ABC_CLASSES, FACT, NUMERIC, RISK_LEVELS
from shelfwise.sources.testdata import daily_fact_from_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and doubles at six places, so that engines can be compared."""
    changed = {
        f.name: round_to(f.name, 6) for f in df.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType))
    }
    return df.withColumns(changed) if changed else df


def query(name: str):
    """Register a function of the workspace under the operator's name."""
    def register(build: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, folder: comparable(build(workspace(spark, folder)))
        return build
    return register


# --- sources, gates and star-schema load -----------------------------------------------------

@query("read_retail_daily")
def _(w: Workspace) -> DataFrame:
    return daily_fact_from_orders(w.spark, w.folder)


@query("read_optional")
def _(w: Workspace) -> DataFrame:
    absent = retail.read_optional(w.spark, new_folder(w.spark, "absent"), FACT)
    path = new_folder(w.spark, "present")
    retail.write_artifact(w.fact, path)
    present = retail.read_optional(w.spark, path, FACT)
    size = lambda df, name: df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "source", F.lit(name))
    return size(absent, "absent").unionByName(size(present, "present"))


@query("write_artifact")
def _(w: Workspace) -> DataFrame:
    path = new_folder(w.spark, "daily-csv")
    retail.write_artifact(w.fact, path, "csv")
    return retail.read_retail_daily(w.spark, path, "csv")


@query("require_columns")
def _(w: Workspace) -> DataFrame:
    return retail.require_columns(w.fact, ["store", "product", "date", "demand"]).groupBy(
        "store").agg(F.sum("demand").alias("demand"))


@query("fallback_column")
def _(w: Workspace) -> DataFrame:
    lean = w.fact.drop("sell_price", "stockout")
    lost = (F.col("lost_sales") > 0).cast("int")
    price = lambda df: retail.fallback_column(df, "sell_price", F.col("unit_price"))
    days = lambda df: F.sum(retail.fallback_column(df, "stockout", lost)).cast("long")
    value = lambda df: F.sum(F.col("lost_sales") * price(df))
    # The lean table is the same rows without two columns, so one pass answers both.
    return w.fact.agg(
        value(w.fact).alias("lost_value_at_sell_price"),
        value(lean).alias("lost_value_at_list_price"),
        days(w.fact).alias("stockout_days"), days(lean).alias("lost_sales_days"))


@query("dq_null_check")
def _(w: Workspace) -> DataFrame:
    # The fact itself has no null cell, so some are made: a rule that finds none proves nothing.
    dirty = w.fact.withColumns({
        "opening_stock": F.when(F.col("opening_stock") % 97 != 0, F.col("opening_stock")),
        "supplier": F.when(F.dayofmonth("date") != 13, F.col("supplier"))})
    return quality.dq_null_check(dirty)


@query("dq_duplicate_check")
def _(w: Workspace) -> DataFrame:
    return quality.dq_duplicate_check(
        w.fact.unionByName(w.fact.where(F.col("opening_stock") % 97 == 0)))


@query("coerce_numeric")
def _(w: Workspace) -> DataFrame:
    text = w.fact.select(*[F.col(c).cast("string").alias(c) for c in NUMERIC])
    numbers = quality.coerce_numeric(text)
    exact = {c: F.col(c).cast("decimal(20,2)") for c in NUMERIC}
    return numbers.withColumns(exact).agg(*[F.sum(c).alias(c) for c in NUMERIC])


@query("dim_stores")
def _(w: Workspace) -> DataFrame:
    return etl.dim_stores(w.fact)


@query("dim_suppliers")
def _(w: Workspace) -> DataFrame:
    return etl.dim_suppliers(w.fact)


@query("dim_products")
def _(w: Workspace) -> DataFrame:
    return etl.dim_products(w.fact, etl.dim_suppliers(w.fact))


@query("fact_sales")
def _(w: Workspace) -> DataFrame:
    return etl.fact_sales(w.fact, w.star["stores"], w.star["products"])


@query("fact_inventory")
def _(w: Workspace) -> DataFrame:
    return etl.fact_inventory(w.fact, w.star["stores"], w.star["products"])


@query("insert_if_absent")
def _(w: Workspace) -> DataFrame:
    known = w.star["suppliers"].select("supplier_id", "supplier_name")
    incoming = w.table("supplier").select(F.col("s_name").alias("supplier_name"))
    return etl.insert_if_absent(known, incoming, "supplier_name", "supplier_id")


@query("reload_star")
def _(w: Workspace) -> DataFrame:
    out_dir = new_folder(w.spark, "star")
    etl.reload_star(w.fact, out_dir)
    return etl.table_counts(etl.open_star(w.spark, out_dir))


@query("table_counts")
def _(w: Workspace) -> DataFrame:
    return etl.table_counts(w.star)


# --- star-schema queries ---------------------------------------------------------------------

def _on_star(operator: Callable[[etl.Star], DataFrame]) -> None:
    query(operator.__name__)(lambda w: operator(w.star))


for _operator in (
    business.biz_top_products, business.biz_store_performance, business.biz_stockout_rate,
    business.biz_lost_sales, business.biz_monthly_demand_growth, business.biz_top3_per_category,
    business.biz_inventory_risk, business.biz_supplier_rule_risk,
    finance_star.fin_monthly_margin, finance_star.fin_budget_vs_actual_sql,
    finance_star.fin_store_turnover, finance_star.fin_abc_sql, finance_star.fin_promotion_sql,
    finance_star.fin_supplier_impact_sql,
):
    _on_star(_operator)


# --- finance on the daily fact ---------------------------------------------------------------

@query("finance_columns")
def _(w: Workspace) -> DataFrame:
    return finance.finance_columns(w.fact).select(
        "date", "store", "product", "unit_cost", "cogs", "gross_profit", "gross_margin_pct",
        "inventory_value", "lost_sales_value")


def _on_fact(operator: Callable[[DataFrame], DataFrame]) -> None:
    query(operator.__name__)(lambda w: operator(w.fact))


for _operator in (
    finance.finance_summary, finance.budget_vs_actual, finance.promotion_effectiveness,
    finance.abc_analysis, finance.supplier_stockout_impact,
):
    _on_fact(_operator)


# --- demand features, forecasts and their evaluation -----------------------------------------

for _operator in (features.daily_demand, features.daily_demand_drivers,
                  features.network_daily_demand, features.pair_coverage):
    _on_fact(_operator)


@query("demand_lags")
def _(w: Workspace) -> DataFrame:
    return features.demand_lags(features.daily_demand(w.fact))


@query("demand_rolling")
def _(w: Workspace) -> DataFrame:
    return features.demand_rolling(features.daily_demand(w.fact))


@query("calendar_features")
def _(w: Workspace) -> DataFrame:
    return features.calendar_features(features.daily_demand(w.fact))


@query("forecast_training_set")
def _(w: Workspace) -> DataFrame:
    return features.forecast_training_set(features.daily_demand_drivers(w.fact))


@query("temporal_split")
def _(w: Workspace) -> DataFrame:
    return features.temporal_split(w.training_set).select(
        "store", "product", "date", "demand", "split")


@query("forecast_metrics")
def _(w: Workspace) -> DataFrame:
    lagged = features.demand_lags(features.daily_demand(w.fact), (7,)).dropna()
    test = features.temporal_split(lagged).where(F.col("split") == "test")
    return forecast.forecast_metrics(test, "demand", "lag_7", forecast.SEASONAL_NAIVE)


@query("naive_baselines")
def _(w: Workspace) -> DataFrame:
    return forecast.naive_baselines(features.daily_demand(w.fact))


@query("recursive_forecast_naive")
def _(w: Workspace) -> DataFrame:
    return w.naive_forecast


def _trees_used(df: DataFrame, trees: int) -> DataFrame:
    return df.withColumn("trees", F.lit(trees))


@query("boosted_forecast")
def _(w: Workspace) -> DataFrame:
    train, test = w.split
    return _trees_used(forecast.boosted_forecast(w.model, train, test), QUERY_PARAMS.trees)


@query("test_predictions")
def _(w: Workspace) -> DataFrame:
    return forecast.test_predictions(w.model, w.split[1])


@query("recursive_forecast")
def _(w: Workspace) -> DataFrame:
    return forecast.recursive_forecast(w.trees, w.drivers)


@query("walk_forward_folds")
def _(w: Workspace) -> DataFrame:
    daily = features.network_daily_demand(w.fact)
    return features.walk_forward_folds(features.demand_features(daily, keys=()).dropna())


@query("walk_forward_validation")
def _(w: Workspace) -> DataFrame:
    return _trees_used(forecast.walk_forward_validation(w.network, FOLD_PARAMS),
                       FOLD_PARAMS.trees)


@query("feature_attribution")
def _(w: Workspace) -> DataFrame:
    return _trees_used(w.attribution, QUERY_PARAMS.trees)


# --- stock policy ----------------------------------------------------------------------------

_on_fact(inventory.inventory_profile)


@query("forecast_kpi")
def _(w: Workspace) -> DataFrame:
    return inventory.forecast_kpi(w.naive_forecast)


def _policy(w: Workspace, ahead: bool) -> DataFrame:
    kpi = inventory.forecast_kpi(w.naive_forecast) if ahead else None
    return inventory.inventory_policy(inventory.inventory_profile(w.fact), kpi)


def _with_and_without_forecast(name: str, build: Callable[[Workspace, bool], DataFrame]) -> None:
    """The query with the seasonal-naive forecast, and its fallback without any forecast."""
    query(name)(lambda w: build(w, True))
    query(f"{name}_fallback")(lambda w: build(w, False))


_with_and_without_forecast("inventory_policy", _policy)
_with_and_without_forecast(
    "economic_order_qty", lambda w, ahead: inventory.economic_order_qty(_policy(w, ahead)))
_with_and_without_forecast("inventory_status", lambda w, ahead: inventory.inventory_status(
    inventory.economic_order_qty(_policy(w, ahead))))
_with_and_without_forecast(
    "inventory_optimization", lambda w, ahead: inventory.inventory_optimization(
        w.fact, w.naive_forecast if ahead else None))


@query("inventory_status_summary")
def _(w: Workspace) -> DataFrame:
    return inventory.inventory_status_summary(w.inventory)


# --- supplier risk and temporal disruption ---------------------------------------------------

_on_fact(supplier.supplier_metrics)


@query("supplier_risk_score")
def _(w: Workspace) -> DataFrame:
    return supplier.supplier_risk_score(supplier.supplier_metrics(w.fact))


@query("supplier_risk_report")
def _(w: Workspace) -> DataFrame:
    return supplier.supplier_risk(w.fact)


_on_fact(temporal.temporal_daily)


@query("temporal_baseline")
def _(w: Workspace) -> DataFrame:
    return temporal.temporal_baseline(temporal.temporal_daily(w.fact))


@query("temporal_pct_change")
def _(w: Workspace) -> DataFrame:
    return temporal.temporal_pct_change(
        temporal.temporal_baseline(temporal.temporal_daily(w.fact)))


@query("disruption_signal")
def _(w: Workspace) -> DataFrame:
    return temporal.disruption_signal(temporal.temporal_pct_change(
        temporal.temporal_baseline(temporal.temporal_daily(w.fact))))


@query("disruption_stage")
def _(w: Workspace) -> DataFrame:
    return temporal.temporal_disruption(w.fact)


# --- actions and impact ----------------------------------------------------------------------

_with_and_without_forecast("action_priorities", lambda w, ahead: (
    actions.action_priorities(w.inventory, w.risk, w.naive_forecast) if ahead
    else actions.action_priorities(w.fallback_inventory, w.risk)))


@query("priority_counts")
def _(w: Workspace) -> DataFrame:
    return actions.priority_counts(w.actions)


@query("latest_state")
def _(w: Workspace) -> DataFrame:
    return actions.latest_state(w.fact).select(
        "store", "product", "date", "closing_stock", "unit_price", "current_stockout")


_with_and_without_forecast("business_impact", lambda w, ahead: actions.business_impact(
    w.fact, w.inventory if ahead else w.fallback_inventory))


# --- validation rules ------------------------------------------------------------------------

@query("validate_finance")
def _(w: Workspace) -> DataFrame:
    return validation.validate_finance({"finance_summary": finance.finance_summary(w.fact)}
                                       ).drop("detail")


@query("validate_abc_impact")
def _(w: Workspace) -> DataFrame:
    pairs = features.pair_coverage(w.fact).scalar()
    return validation.validate_abc_impact(
        {"abc_analysis": finance.abc_analysis(w.fact),
         "business_impact": actions.business_impact(w.fact, w.inventory)}, pairs).drop("detail")


# --- dashboard queries -----------------------------------------------------------------------

@query("kpi_strip_without_disruption")
def _(w: Workspace) -> DataFrame:
    return views.kpi_strip(w.actions, w.risk)


@query("action_view")
def _(w: Workspace) -> DataFrame:
    return views.action_view(w.actions, store="ASIA", priority="MEDIUM")


@query("level_counts")
def _(w: Workspace) -> DataFrame:
    named = lambda df, column, levels: views.level_counts(df, column, levels).withColumn(
        "measure", F.lit(column))
    return named(finance.abc_analysis(w.fact), "abc_class", ABC_CLASSES).unionByName(
        named(w.risk, "risk_level", RISK_LEVELS))


@query("score_histogram")
def _(w: Workspace) -> DataFrame:
    scored = supplier.supplier_metrics(w.fact).select(supplier.risk_index().alias("risk"))
    return views.score_histogram(scored, "risk")


@query("disruption_timeline")
def _(w: Workspace) -> DataFrame:
    chosen = w.fact.agg(F.min(F.struct("supplier", "product")).alias("key")).first()["key"]
    return views.disruption_timeline(temporal.temporal_disruption(w.fact), *chosen)


@query("forecast_pairs")
def _(w: Workspace) -> DataFrame:
    return views.forecast_pairs(w.naive_forecast)


@query("forecast_totals")
def _(w: Workspace) -> DataFrame:
    return views.forecast_totals(w.naive_forecast)


@query("model_benchmark")
def _(w: Workspace) -> DataFrame:
    baselines = forecast.naive_baselines(features.daily_demand(w.fact))
    return views.model_benchmark(baselines, baselines)


@query("top_exposure")
def _(w: Workspace) -> DataFrame:
    return views.top_exposure(finance.supplier_stockout_impact(w.fact))


@query("top_revenue_products")
def _(w: Workspace) -> DataFrame:
    return views.top_revenue_products(finance.abc_analysis(w.fact))


# --- supplier disruption ---------------------------------------------------------------------

_on_fact(disruption.supplier_features)


@query("scale_features")
def _(w: Workspace) -> DataFrame:
    return disruption.scale_features(disruption.supplier_features(w.fact))


def _by_feature(w: Workspace) -> DataFrame:
    """Three supplier groups along one scaled feature each: labelings without a random start."""
    def labelled(name: str) -> DataFrame:
        value = F.col("vec")[disruption.FEATURES.index(name)]
        label = F.when(value < -0.5, 0).when(value < 0.5, 1).otherwise(2)
        return w.vectors.select(F.lit(name).alias("run"), "entity", "vec", label.alias("label"))

    return reduce(DataFrame.unionByName, [
        labelled(n) for n in ("average_lead_time", "on_time_percentage", "fill_percentage",
                              "demand_mean")])


for _score in (cluster_scores.silhouette, cluster_scores.davies_bouldin,
               cluster_scores.calinski_harabasz):
    query(_score.__name__)(lambda w, score=_score: score(_by_feature(w)))


@query("kmeans_sweep")
def _(w: Workspace) -> DataFrame:
    ks = list(range(2, min(8, w.vectors.count() - 1) + 1))
    return clustering.kmeans_sweep(w.vectors, ks)


@query("hierarchical_clusters")
def _(w: Workspace) -> DataFrame:
    return clustering.hierarchical_clusters(w.vectors)


@query("dbscan_clusters")
def _(w: Workspace) -> DataFrame:
    needed = clustering.min_samples_for(w.vectors.count())
    return clustering.dbscan_clusters(w.vectors, min_samples=needed)


@query("compare_clustering")
def _(w: Workspace) -> DataFrame:
    return w.comparison


@query("choose_best")
def _(w: Workspace) -> DataFrame:
    labelled = _by_feature(w)
    shape = labelled.groupBy("run").agg(F.count_distinct("label").alias("clusters"))
    results = cluster_scores.cluster_scores(labelled).join(shape, "run").select(
        F.lit("Hierarchical").alias("model"),
        F.concat(F.lit("feature="), "run").alias("parameters"), "clusters", "silhouette",
        "davies_bouldin", "calinski_harabasz")
    results = materialise(results)
    chosen = lambda order: clustering.choose_best(results, order).withColumn(
        "choice_order", F.lit(order))
    return chosen("best").unionByName(chosen("reference"))


@query("fit_cluster")
def _(w: Workspace) -> DataFrame:
    return clustering.fit_cluster(w.vectors, "Hierarchical", 4)


@query("pca_2d")
def _(w: Workspace) -> DataFrame:
    return disruption.pca_2d(w.vectors)


@query("isolation_forest")
def _(w: Workspace) -> DataFrame:
    return anomaly.isolation_forest(w.vectors)


@query("pct_rank")
def _(w: Workspace) -> DataFrame:
    pairs = w.fact.groupBy("store", "product").agg(F.sum("stockout").alias("stockout_days"))
    return pct_rank(pairs, "stockout_days", keys=["store", "product"])


@query("disruption_score")
def _(w: Workspace) -> DataFrame:
    return disruption.disruption_score(disruption.supplier_features(w.fact), "stockout_rate")


# --- the whole chain and its validation ------------------------------------------------------

@query("disruption_detection")
def _(w: Workspace) -> DataFrame:
    return w.results["disruption_detection"]


@query("kpi_strip")
def _(w: Workspace) -> DataFrame:
    return views.kpi_strip(w.results["action_priorities"], w.results["supplier_risk"],
                           w.results["disruption_detection"])


@query("validate_schemas")
def _(w: Workspace) -> DataFrame:
    return validation.validate_schemas(w.spark, w.results)


def _pairs(w: Workspace) -> int:
    return features.pair_coverage(w.fact).first()["sku_store_pairs"]


@query("validate_forecast")
def _(w: Workspace) -> DataFrame:
    return validation.validate_forecast(w.results, _pairs(w))


@query("validate_disruption")
def _(w: Workspace) -> DataFrame:
    return validation.validate_disruption(w.results)


@query("validation_report")
def _(w: Workspace) -> DataFrame:
    return validation.validation_report(w.spark, w.results, _pairs(w))
