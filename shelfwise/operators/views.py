"""Queries behind the dashboard: counts, filters, histograms, timelines, top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.operators.features import SERIES

# Fixed column order of the action table as shown to users.
ACTION_COLUMNS = ["priority", "action", "store", "product", "category", "supplier",
                  "inventory_status", "days_of_stock", "shortage_to_rop",
                  "recommended_order_qty", "average_30_day_forecast", "risk_level"]
EVERYTHING = "all"


def kpi_strip(actions: DataFrame, risk: DataFrame | None = None,
              disruption: DataFrame | None = None) -> DataFrame:
    """One row of six counts; a table that is not there counts zero."""
    def level_count(df: DataFrame | None, column: str, level: str):
        if df is None or column not in df.columns:
            return F.lit(0).cast("long")
        return df.agg(F.count_if(F.col(column) == level)).scalar()

    return actions.agg(
        F.count(F.lit(1)).alias("store_product_pairs"),
        F.count_if(F.col("priority").isin("HIGH", "URGENT")).alias("high_priority"),
        F.count_if(F.col("inventory_status") == "CRITICAL").alias("critical_inventory"),
        F.count_if(F.col("inventory_status") == "REORDER").alias("reorder_inventory"),
    ).withColumns({
        "high_risk_suppliers": level_count(risk, "risk_level", "HIGH"),
        "critical_disruptions": level_count(disruption, "disruption_level", "CRITICAL"),
    })


def action_view(actions: DataFrame, store: str = EVERYTHING,
                priority: str = EVERYTHING) -> DataFrame:
    """Actions of one store and/or priority, with the columns users see (those present)."""
    view = actions
    if store != EVERYTHING:
        view = view.where(F.col("store") == store)
    if priority != EVERYTHING:
        view = view.where(F.col("priority") == priority)
    return view.select(*[c for c in ACTION_COLUMNS if c in actions.columns])


def level_counts(df: DataFrame, column: str, levels: list[str]) -> DataFrame:
    """Rows per level in the given order, zero for a level that does not occur."""
    counted = df.agg(*[F.count_if(F.col(column) == level).alias(level) for level in levels])
    pairs = F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(level).alias("row_count"))
        for level in levels])
    return counted.select(F.explode(pairs).alias("c")).select("c.level", "c.row_count")


def score_histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width, right-closed bins from minimum to maximum; the first takes the minimum.

    The first edge is moved down by 0.1 % of the range. When all values are equal the range is
    widened by 0.1 % of the value on both sides.
    """
    span = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    pad = F.when(~flat, 0.0).when(F.col("lo") == 0, 0.001).otherwise(0.001 * F.abs("lo"))
    widened = span.select((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi"),
                          flat.alias("flat"))
    edges = widened.select(F.array(*[
        F.col("lo") + n * ((F.col("hi") - F.col("lo")) / bins) for n in range(bins + 1)
    ]).alias("edges"), F.when(F.col("flat"), F.col("lo")).otherwise(
        F.col("lo") - 0.001 * (F.col("hi") - F.col("lo"))).alias("first"))
    inner = F.slice(edges.select("edges").scalar(), 2, bins - 1)
    place = F.size(F.filter("_edges", lambda edge: edge < F.col(column))) + 1
    known = df.where(F.col(column).isNotNull()).withColumn("_edges", inner)
    counted = known.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("found"))
    every = edges.select(
        "edges", "first", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    low = F.when(F.col("bin") == 1, F.col("first")).otherwise(F.get("edges", F.col("bin") - 1))
    return every.join(counted, "bin", "left").select(
        "bin", low.alias("bin_from"), F.get("edges", F.col("bin")).alias("bin_to"),
        F.coalesce("found", F.lit(0).cast("long")).alias("row_count")).orderBy("bin")


def disruption_timeline(temporal: DataFrame, supplier: str, product: str) -> DataFrame:
    """Signal of one supplier and product over time."""
    return (
        temporal.where((F.col("supplier") == supplier) & (F.col("product") == product))
        .select("supplier", "product", "date", "disruption_signal").orderBy("date")
    )


def forecast_pairs(forecast: DataFrame) -> DataFrame:
    return forecast.select(*SERIES).distinct().orderBy(*SERIES)


def forecast_totals(forecast: DataFrame, store: str = EVERYTHING,
                    product: str = EVERYTHING) -> DataFrame:
    """Total and daily average of the forecast, per pair."""
    view = forecast
    if store != EVERYTHING:
        view = view.where(F.col("store") == store)
    if product != EVERYTHING:
        view = view.where(F.col("product") == product)
    return view.groupBy(*SERIES).agg(
        F.sum("forecast_demand").alias("total_forecast"),
        F.avg("forecast_demand").alias("average_forecast"))


def model_benchmark(*results: DataFrame) -> DataFrame:
    """Metrics of all models by rising MAE; a repeated model keeps its first table's row."""
    columns = ["model", "MAE", "RMSE", "MAPE"]
    stacked = None
    for place, result in enumerate(results):
        part = result.select(*columns, F.lit(place).alias("_place"))
        stacked = part if stacked is None else stacked.unionByName(part)
    first = F.row_number().over(W.partitionBy("model").orderBy("_place", "MAE", "RMSE", "MAPE"))
    return stacked.withColumn("_first", first).where("_first = 1").select(*columns).orderBy(
        "MAE", "model")


def top_exposure(impact: DataFrame, top: int = 10) -> DataFrame:
    """Suppliers with the largest lost sales value."""
    return impact.orderBy(F.desc("lost_sales_value"), "supplier").limit(top)


def top_revenue_products(abc: DataFrame, top: int = 30) -> DataFrame:
    """First products of the ABC table."""
    return abc.orderBy(F.desc("revenue"), "product").limit(top)
