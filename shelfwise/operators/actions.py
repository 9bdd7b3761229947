"""Prioritised replenishment actions and business impact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import rank_of, round_to
from shelfwise.operators.features import SERIES
from shelfwise.operators.views import level_counts
from shelfwise.sources.retail import fallback_column, require_columns
from shelfwise.sources.schema import PRIORITIES

# Fixed action text per priority.
ACTION_TEXT = {"URGENT": "Expedite + supplier escalation", "HIGH": "Expedite replenishment",
               "MEDIUM": "Plan replenishment", "LOW": "Monitor"}


def action_priorities(inventory: DataFrame, suppliers: DataFrame,
                      forecast: DataFrame | None = None) -> DataFrame:
    """Stock status joined with forecast and supplier risk, ranked by urgency.

    The supplier join has a hot key when one supplier serves many pairs. No hint is given: a
    risk table below the broadcast threshold is broadcast, a larger one is joined by sort-merge,
    where adaptive execution splits the hot supplier's partition.
    """
    if forecast is None:
        joined = inventory.withColumns({
            "average_30_day_forecast": F.lit(None).cast("double"),
            "total_30_day_forecast": F.lit(None).cast("double")})
    else:
        joined = inventory.join(forecast.groupBy(*SERIES).agg(
            F.avg("forecast_demand").alias("average_30_day_forecast"),
            F.sum("forecast_demand").alias("total_30_day_forecast")), SERIES, "left")
    critical = F.col("inventory_status") == "CRITICAL"
    priority = (
        F.when(critical & (F.col("risk_level") == "HIGH"), "URGENT").when(critical, "HIGH")
        .when(F.col("inventory_status") == "REORDER", "MEDIUM").otherwise("LOW")
    )
    ranked = joined.join(suppliers, "supplier", "left").withColumn("priority", priority)
    action = F.lit(None).cast("string")
    for level, text in ACTION_TEXT.items():
        action = F.when(F.col("priority") == level, text).otherwise(action)
    return ranked.withColumn("action", action).orderBy(
        rank_of("priority", PRIORITIES), F.desc("shortage_to_rop"), *SERIES)


def priority_counts(actions: DataFrame) -> DataFrame:
    """Rows per priority, every level present."""
    return level_counts(actions, "priority", PRIORITIES).withColumnRenamed("level", "priority")


def latest_state(fact: DataFrame) -> DataFrame:
    """The newest row of each pair; of several on that date, the largest by the other columns.

    The newest dates are a hash aggregation; only the rows of those dates are compared whole.
    """
    rest = [c for c in fact.columns if c not in (*SERIES, "date")]
    dates = fact.groupBy(*SERIES).agg(F.max("date").alias("date"))
    last = fact.join(dates, [*SERIES, "date"])
    newest = last.groupBy(*SERIES).agg(F.max(F.struct("date", *rest)).alias("row"))
    return newest.select(*SERIES, "row.*").withColumn(
        "current_stockout", F.col("closing_stock") <= 0)


def business_impact(fact: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """One row of KPIs; the inventory part only when that table (and its columns) is given."""
    require_columns(fact, [*SERIES, "date", "demand", "lost_sales", "unit_price",
                           "closing_stock"])
    price = fallback_column(fact, "sell_price", F.col("unit_price"))
    stockout = fallback_column(fact, "stockout", (F.col("lost_sales") > 0).cast("int"))
    # One pass: history sums and the newest stock come from the same per-pair aggregation.
    pairs = fact.groupBy(*SERIES).agg(
        F.sum(stockout).alias("stockouts"), F.sum(F.col("lost_sales") * price).alias("lost"),
        F.max_by("closing_stock", "date").alias("stock"),
        F.max_by("unit_price", "date").alias("price"))
    stock = F.col("stock")
    kpis = pairs.agg(
        F.count(F.lit(1)).alias("total_sku_store_pairs"),
        F.count_if(stock <= 0).alias("current_stockout_pairs"),
        F.sum("stockouts").alias("historical_stockout_days"),
        F.round(F.sum("lost"), 2).alias("historical_lost_sales_value"),
        F.round(F.sum(stock * F.col("price") * F.lit(Decimal("0.60"))), 2)
        .alias("current_inventory_value"))
    if inventory is None:
        return kpis
    extra = {}
    if "recommended_order_qty" in inventory.columns:
        extra["recommended_replenishment_units"] = round_to(F.sum("recommended_order_qty"), 2)
    if "inventory_status" in inventory.columns:
        for status in ("CRITICAL", "REORDER", "NORMAL"):
            extra[f"{status.lower()}_inventory_pairs"] = F.count_if(
                F.col("inventory_status") == status)
    if "low_coverage_7d" in inventory.columns:
        extra["low_coverage_pairs_7d"] = F.sum("low_coverage_7d")
    if not extra:
        return kpis
    found = inventory.agg(F.struct(*[c.alias(n) for n, c in extra.items()])).scalar()
    return kpis.withColumns({name: found[name] for name in extra})
