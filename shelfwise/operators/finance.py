"""Finance KPIs straight from the daily fact."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, ratio, ratio_or_zero
from shelfwise.functions.ordering import running_totals
from shelfwise.operators.finance_star import abc_class

UNIT_COST_RATE = Decimal("0.60")
HOLDING_RATE = 0.25


def finance_columns(fact: DataFrame, unit_cost_rate=UNIT_COST_RATE) -> DataFrame:
    """Add cost, profit, margin, stock value and lost value per row; money stays decimal."""
    rate = F.lit(Decimal(str(unit_cost_rate)))
    unit_cost = F.col("unit_price") * rate
    priced = lambda units: (F.col(units) * unit_cost).cast("decimal(24,4)")
    return fact.withColumns({
        "unit_cost": unit_cost,
        "cogs": priced("units_sold"),
        "inventory_value": priced("closing_stock"),
        "lost_sales_value": (F.col("lost_sales") * F.col("sell_price")).cast("decimal(20,2)"),
    }).withColumn("gross_profit", F.col("revenue") - F.col("cogs")).withColumn(
        "gross_margin_pct",
        F.when(F.col("revenue") > 0, 100.0 * ratio("gross_profit", "revenue")).otherwise(0.0))


def finance_summary(fact: DataFrame, unit_cost_rate=UNIT_COST_RATE,
                    holding_rate: float = HOLDING_RATE) -> DataFrame:
    """One row of KPIs from a single aggregation."""
    sums = finance_columns(fact, unit_cost_rate).agg(
        F.sum("revenue").alias("revenue"), F.sum("cogs").alias("cogs"),
        F.sum("inventory_value").alias("stock_value"), F.count("inventory_value").alias("n"),
        F.sum("lost_sales_value").alias("historical_lost_sales_value"))
    average = ratio("stock_value", "n")
    turnover = ratio_or_zero("cogs", average)
    profit = F.col("revenue") - F.col("cogs")
    return sums.select(
        "revenue", "cogs", profit.alias("gross_profit"),
        (100.0 * ratio_or_zero(profit, "revenue")).alias("gross_margin_pct"),
        average.alias("average_inventory_value"),
        turnover.alias("inventory_turnover"),
        ratio_or_zero(F.lit(365.0), turnover).alias("days_inventory_outstanding"),
        (average * holding_rate).alias("annual_holding_cost"),
        "historical_lost_sales_value")


def budget_vs_actual(fact: DataFrame, unit_cost_rate=UNIT_COST_RATE) -> DataFrame:
    """Monthly actuals against budgets grown from the month before, with variances."""
    monthly = finance_columns(fact, unit_cost_rate).groupBy(
        F.trunc("date", "MM").alias("month")).agg(
        F.sum("revenue").alias("actual_revenue"), F.sum("cogs").alias("actual_cogs"),
        F.sum("gross_profit").alias("actual_gross_profit"))
    in_order = W.orderBy("month")  # one row per month
    grown = lambda name, growth: F.coalesce(
        F.lag(name).over(in_order) * F.lit(Decimal(growth)), F.col(name))
    budget = monthly.withColumns({
        "budget_revenue": grown("actual_revenue", "1.05"),
        "budget_cogs": grown("actual_cogs", "1.03"),
    }).withColumn("budget_gross_profit", F.col("budget_revenue") - F.col("budget_cogs"))
    variance = lambda name: F.col(f"actual_{name}") - F.col(f"budget_{name}")
    margin = lambda side: 100.0 * ratio(f"{side}_gross_profit", f"{side}_revenue")
    result = budget.withColumns({
        "revenue_variance": variance("revenue"),
        "revenue_variance_pct": 100.0 * ratio(variance("revenue"), "budget_revenue"),
        "cogs_variance": variance("cogs"),
        "gross_profit_variance": variance("gross_profit"),
        "margin_variance_pct": margin("actual") - margin("budget"),
    })
    return result.fillna(0, [c for c in result.columns if c != "month"]).orderBy("month")


def promotion_effectiveness(fact: DataFrame) -> DataFrame:
    """Promotion days against the rest, with daily averages and conversion."""
    totals = fact.where(F.col("promo_event").isNotNull()).groupBy("promo_event").agg(
        F.count("date").alias("days"), F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"), F.sum("demand").alias("demand"))
    label = (
        F.when(F.col("promo_event") == 0, "Non-promotion")
        .when(F.col("promo_event") == 1, "Promotion").otherwise("0")
    )
    return totals.withColumns({
        "average_daily_units": ratio_or_zero("units_sold", "days"),
        "average_daily_revenue": ratio_or_zero("revenue", "days"),
        "conversion_pct": 100.0 * ratio_or_zero("units_sold", "demand"),
        "promo_label": label,
    }).orderBy("promo_event")


def abc_analysis(fact: DataFrame) -> DataFrame:
    """Products by falling revenue, running share, class A/B/C; ties ordered by product."""
    revenue = fact.groupBy("category", "product").agg(F.sum("revenue").alias("revenue"))
    ordered = running_totals(
        revenue, [F.desc("revenue"), F.col("product"), F.col("category")],
        {"running": F.col("revenue")})
    total: Column = F.col("running_total")
    return ordered.select(
        "category", "product", "revenue",
        (100.0 * ratio("revenue", total)).alias("revenue_share_pct"),
        (100.0 * ratio("running", total)).alias("cumulative_share_pct"),
        abc_class(F.col("running"), total).alias("abc_class"),
    ).orderBy(F.desc("revenue"), "product")


def supplier_stockout_impact(fact: DataFrame) -> DataFrame:
    """Revenue, lost sales and service averages per supplier, largest exposure first."""
    return (
        fact.withColumn("_lost", F.col("lost_sales") * F.col("sell_price"))
        .groupBy("supplier")
        .agg(F.sum("revenue").alias("revenue"),
             F.sum("lost_sales").alias("lost_sales_units"),
             F.sum("_lost").alias("lost_sales_value"),
             F.sum("stockout").alias("stockout_days"),
             F.avg(as_double("lead_time_days")).alias("average_lead_time_days"),
             F.avg("on_time_rate").alias("on_time_rate"),
             F.avg("defect_rate").alias("defect_rate"))
        .orderBy(F.desc("lost_sales_value"), "supplier")
    )
