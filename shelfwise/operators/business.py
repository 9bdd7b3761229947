"""Analyst queries on the star schema: sales, stockouts, demand, stock and supplier rules.

Sales and inventory are summed by surrogate id before the dimension join, so the join sees one
row per product or store instead of one per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import ratio, rank_of, round_to
from shelfwise.operators.etl import Star, latest_day

PRODUCT_NAMES = ["product_id", "product_name", "category"]


def _per_product(star: Star, table: str, **sums: Column) -> DataFrame:
    totals = star[table].groupBy("product_id").agg(*[c.alias(n) for n, c in sums.items()])
    return totals.join(star["products"].select(*PRODUCT_NAMES), "product_id")


def biz_top_products(star: Star, top: int = 10) -> DataFrame:
    """Units and revenue per product, highest revenue first."""
    return (
        _per_product(star, "sales", total_units_sold=F.sum("units_sold"),
                     total_revenue=F.round(F.sum("revenue"), 2))
        .select("product_name", "category", "total_units_sold", "total_revenue")
        .orderBy(F.desc("total_revenue"), "product_name").limit(top)
    )


def biz_store_performance(star: Star) -> DataFrame:
    """Units, revenue and revenue per unit of each store."""
    totals = star["sales"].groupBy("store_id").agg(
        F.sum("units_sold").alias("total_units_sold"), F.sum("revenue").alias("revenue"))
    return (
        totals.join(star["stores"], "store_id")
        .select("store_name", "total_units_sold", F.round("revenue", 2).alias("total_revenue"),
                round_to(ratio("revenue", "total_units_sold"), 2).alias("revenue_per_unit"))
        .orderBy(F.desc("total_revenue"), "store_name")
    )


def biz_stockout_rate(star: Star) -> DataFrame:
    """Share of days out of stock per product."""
    return (
        _per_product(star, "inventory", total_days=F.count(F.lit(1)),
                     stockout_days=F.sum("stockout"))
        .select("product_name", "category", "total_days", "stockout_days",
                round_to(100.0 * ratio("stockout_days", "total_days"), 2).alias("stockout_rate"))
        .orderBy(F.desc("stockout_rate"), "product_name")
    )


def biz_lost_sales(star: Star, top: int = 10) -> DataFrame:
    """Demand, sold and lost units per product, most lost first."""
    return (
        _per_product(star, "sales", total_demand=F.sum("demand"),
                     total_units_sold=F.sum("units_sold"), total_lost_sales=F.sum("lost_sales"))
        .select("product_name", "category", "total_demand", "total_units_sold",
                "total_lost_sales",
                round_to(100.0 * ratio("total_lost_sales", "total_demand"), 2)
                .alias("lost_sales_rate"))
        .orderBy(F.desc("total_lost_sales"), "product_name").limit(top)
    )


def month_of(column: str) -> Column:
    return F.trunc(column, "MM")


def biz_monthly_demand_growth(star: Star) -> DataFrame:
    """Demand by month with the change against the month before (one row per month)."""
    monthly = star["sales"].groupBy(month_of("sale_date").alias("month")).agg(
        F.sum("demand").alias("total_demand"))
    before = F.lag("total_demand").over(W.orderBy("month"))
    return (
        monthly.withColumn("previous_month_demand", before)
        .withColumn("growth_percentage", round_to(
            100.0 * ratio(F.col("total_demand") - F.col("previous_month_demand"),
                          "previous_month_demand"), 2))
        .orderBy("month")
    )


def biz_top3_per_category(star: Star, top: int = 3) -> DataFrame:
    """Best products by revenue within each category; equal revenue shares its rank."""
    revenue = _per_product(star, "sales", revenue=F.sum("revenue"))
    place = F.rank().over(W.partitionBy("category").orderBy(F.desc("revenue")))
    return (
        revenue.withColumn("category_rank", place).where(F.col("category_rank") <= top)
        .select("category", "product_name", F.round("revenue", 2).alias("total_revenue"),
                "category_rank")
        .orderBy("category", "category_rank", "product_name")
    )


def biz_inventory_risk(star: Star) -> DataFrame:
    """Stock against the stored reorder point on the latest day of the whole table."""
    status = (
        F.when(2 * F.col("closing_stock") <= F.col("reorder_point"), "CRITICAL")
        .when(F.col("closing_stock") <= F.col("reorder_point"), "HIGH")
        .otherwise("NORMAL")
    )
    return (
        latest_day(star["inventory"], "inventory_date")
        .join(star["stores"], "store_id")
        .join(star["products"].select(*PRODUCT_NAMES), "product_id")
        .select("store_name", "product_name", "category", "inventory_date", "closing_stock",
                "reorder_point", status.alias("inventory_status"))
        .orderBy(rank_of("inventory_status", ["CRITICAL", "HIGH", "NORMAL"]),
                 "store_name", "product_name")
    )


def biz_supplier_rule_risk(star: Star) -> DataFrame:
    """Rule-based risk level of each supplier."""
    on_time, defect = F.col("on_time_rate"), F.col("defect_rate")
    level = (
        F.when((on_time < 0.90) | (defect > 0.05), "HIGH")
        .when((on_time < 0.95) | (defect > 0.03), "MEDIUM")
        .otherwise("LOW")
    )
    return (
        star["suppliers"]
        .select("supplier_name", "lead_time_days", "on_time_rate", "defect_rate",
                level.alias("supplier_risk"))
        .orderBy(rank_of("supplier_risk", ["HIGH", "MEDIUM", "LOW"]), "supplier_name")
    )
