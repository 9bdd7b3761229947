"""Finance queries on the star schema; unit cost is a share of the list price."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, ratio, round_to
from shelfwise.functions.ordering import running_totals
from shelfwise.operators.business import PRODUCT_NAMES, month_of
from shelfwise.operators.etl import Star

COST_RATE = Decimal("0.60")


def cost_of(units: str, price: str = "unit_price") -> Column:
    """Exact decimal cost of the units at the assumed cost rate."""
    return (F.col(units) * F.col(price) * F.lit(COST_RATE)).cast("decimal(24,4)")


def _monthly(star: Star) -> DataFrame:
    return star["sales"].groupBy(month_of("sale_date").alias("month")).agg(
        F.sum("revenue").alias("revenue"), F.sum(cost_of("units_sold")).alias("cogs"))


def fin_monthly_margin(star: Star) -> DataFrame:
    """Revenue, cost, gross profit and margin by month."""
    profit = F.col("revenue") - F.col("cogs")
    return (
        _monthly(star)
        .withColumns({
            "gross_profit": profit,
            "gross_margin_pct": round_to(100.0 * ratio(profit, "revenue"), 2),
        })
        .orderBy("month")
    )


def fin_budget_vs_actual_sql(star: Star) -> DataFrame:
    """Budget = last month's revenue plus 5 % and cost plus 3 %; the first month is its own."""
    in_order = W.orderBy("month")  # one row per month
    budgeted = lambda name, growth: F.coalesce(
        F.lag(name).over(in_order) * F.lit(Decimal(growth)), F.col(name))
    return (
        _monthly(star)
        .select("month",
                F.col("revenue").alias("actual_revenue"), F.col("cogs").alias("actual_cogs"),
                budgeted("revenue", "1.05").alias("budget_revenue"),
                budgeted("cogs", "1.03").alias("budget_cogs"))
        .select("month", "budget_revenue", "actual_revenue",
                (F.col("actual_revenue") - F.col("budget_revenue")).alias("revenue_variance"),
                round_to(100.0 * ratio(F.col("actual_revenue") - F.col("budget_revenue"),
                                       "budget_revenue"), 2).alias("revenue_variance_pct"),
                "budget_cogs", "actual_cogs",
                (F.col("actual_cogs") - F.col("budget_cogs")).alias("cogs_variance"))
        .orderBy("month")
    )


DAY_KEYS = ["store_id", "product_id", "day"]


def _sales_with_stock(star: Star, sales: list[str], stock: list[str]) -> DataFrame:
    """Match each day's sales with that day's stock on the full three-column key."""
    return star["sales"].select("store_id", "product_id", F.col("sale_date").alias("day"), *sales
                                ).join(
        star["inventory"].select("store_id", "product_id",
                                 F.col("inventory_date").alias("day"), *stock), DAY_KEYS)


def fin_store_turnover(star: Star) -> DataFrame:
    """Cost, row-level average stock value, turnover and days of inventory per store."""
    per_pair = _sales_with_stock(star, ["units_sold", "unit_price"], ["closing_stock"]).groupBy(
        "store_id", "product_id").agg(
        F.sum(cost_of("units_sold")).alias("cogs"),
        F.sum("closing_stock").alias("stock"),
        F.count(F.lit(1)).alias("days"))
    per_store = (
        per_pair.join(star["products"].select("product_id", "unit_price"), "product_id")
        .groupBy("store_id")
        .agg(F.sum("cogs").alias("cogs"),
             F.sum(cost_of("stock")).alias("stock_value"), F.sum("days").alias("days"))
        .join(star["stores"], "store_id")
    )
    average = ratio("stock_value", "days")
    turnover = ratio("cogs", average)
    return per_store.select(
        F.col("store_name").alias("store"), "cogs", average.alias("average_inventory_value"),
        round_to(turnover, 2).alias("inventory_turnover"),
        round_to(ratio(F.lit(365.0), turnover), 2).alias("dio"),
    ).orderBy("store")


def abc_class(running: Column, total: Column) -> Column:
    """A up to 80 % of the total, B up to 95 %, else C, compared exactly."""
    return (
        F.when(running * 100 <= total * 80, "A")
        .when(running * 100 <= total * 95, "B")
        .otherwise("C")
    )


def fin_abc_sql(star: Star) -> DataFrame:
    """Products by falling revenue with their running share and class."""
    revenue = (
        star["sales"].groupBy("product_id").agg(F.sum("revenue").alias("revenue"))
        .join(star["products"].select(*PRODUCT_NAMES), "product_id")
        .select(F.col("product_name").alias("product"), "category", "revenue")
    )
    ordered = running_totals(
        revenue, [F.desc("revenue"), F.col("product")], {"running": F.col("revenue")})
    total = F.col("running_total")
    return ordered.select(
        "product", "category", "revenue",
        round_to(100.0 * ratio("revenue", total), 2).alias("revenue_share_pct"),
        round_to(100.0 * ratio("running", total), 2).alias("cumulative_share_pct"),
        abc_class(F.col("running"), total).alias("abc_class"),
    ).orderBy(F.desc("revenue"), "product")


def fin_promotion_sql(star: Star) -> DataFrame:
    """Promotion days against the rest."""
    totals = star["sales"].groupBy("promo_event").agg(
        F.count(F.lit(1)).alias("days"), F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"), F.sum("demand").alias("demand"))
    return totals.orderBy("promo_event").select(
        F.when(F.col("promo_event") == 1, "Promotion").otherwise("Non-promotion")
        .alias("promo_label"),
        "days", "units_sold", "revenue",
        round_to(ratio("units_sold", "days"), 2).alias("average_daily_units"),
        round_to(ratio("revenue", "days"), 2).alias("average_daily_revenue"),
        round_to(100.0 * ratio("units_sold", "demand"), 2).alias("conversion_pct"))


def fin_supplier_impact_sql(star: Star) -> DataFrame:
    """Lost units and their value, stockout days and service figures per supplier."""
    per_product = _sales_with_stock(star, ["lost_sales", "sell_price"], ["stockout"]).groupBy(
        "product_id").agg(
        F.sum("lost_sales").alias("lost"),
        F.sum(F.col("lost_sales") * F.col("sell_price")).alias("value"),
        F.sum("stockout").alias("stockouts"), F.count(F.lit(1)).alias("days"))
    joined = per_product.join(
        star["products"].select("product_id", "supplier_id"), "product_id"
    ).join(star["suppliers"], "supplier_id")
    mean = lambda name: round_to(
        ratio(F.sum(as_double(name) * F.col("days")), F.sum("days")), 2)
    return (
        joined.groupBy("supplier_id", F.col("supplier_name").alias("supplier"))
        .agg(F.sum("lost").alias("lost_sales_units"),
             F.round(F.sum("value"), 2).alias("lost_sales_value"),
             F.sum("stockouts").alias("stockout_days"),
             mean("lead_time_days").alias("average_lead_time_days"),
             mean("on_time_rate").alias("on_time_rate"),
             mean("defect_rate").alias("defect_rate"))
        .drop("supplier_id")
        .orderBy(F.desc("lost_sales_value"), "supplier")
    )
