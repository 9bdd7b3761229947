"""Forecast-driven stock policy per (store, product)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, ratio, round_to
from shelfwise.functions.ordering import exact_median
from shelfwise.functions.storage import materialise
from shelfwise.operators.features import SERIES

# Fixed policy constants.
SERVICE_Z = 1.645
ORDER_COST = 2000.0
HOLDING_RATE = 0.25
CAP_DAYS = 30

ROUNDED = ["annual_demand", "forecast_daily_demand", "forecast_30_day_demand", "demand_std",
           "safety_stock", "expected_lead_time_demand", "reorder_point", "eoq",
           "recommended_order_qty", "shortage_to_rop", "days_of_stock",
           "historical_stockout_rate"]


def inventory_profile(fact: DataFrame) -> DataFrame:
    """History per pair; demand is annualised over the date span of the whole fact.

    The pass over the fact groups by the text columns too and keeps only numbers, which Spark can
    hash-aggregate; which category and supplier come first is settled on the small result. The
    deviation follows from exact integer sums.
    """
    span = fact.agg(
        F.greatest(F.datediff(F.max("date"), F.min("date")) + 1, F.lit(1))).scalar()
    price, lead = as_double("unit_price"), as_double("lead_time_days")
    parts = fact.groupBy(*SERIES, "category", "supplier").agg(
        F.min("date").alias("first"), F.max("date").alias("last"),
        F.max_by("closing_stock", "date").alias("stock"),
        F.sum("demand").alias("demand"), F.sum(F.col("demand") * F.col("demand")).alias("squares"),
        F.count("demand").alias("n"), F.sum(price).alias("price"), F.count(price).alias("prices"),
        F.sum(lead).alias("lead"), F.count(lead).alias("leads"),
        F.sum("stockout").alias("stockouts"), F.count("date").alias("days"))
    exact = lambda name: F.sum(F.col(name).cast("decimal(19,0)")).cast("decimal(19,0)")
    # n * sum of squares - square of the sum, over n * (n - 1)
    spread = exact("n") * exact("squares") - exact("demand") * exact("demand")
    n = as_double(F.sum("n"))
    pairs = parts.groupBy(*SERIES).agg(
        F.min_by("category", "first").alias("category"),
        F.min_by("supplier", "first").alias("supplier"),
        F.sum("demand").alias("total_demand"),
        ratio(F.sum("price"), F.sum("prices")).alias("unit_price"),
        ratio(F.sum("lead"), F.sum("leads")).alias("lead_time_days"),
        F.max_by("stock", "last").alias("current_stock"),
        F.sqrt(ratio(spread, n * (n - 1))).alias("demand_std"),
        F.sum("stockouts").alias("historical_stockout_days"),
        F.sum("days").alias("observed_days"))
    return pairs.withColumns({
        "annual_demand": F.col("total_demand") * (F.lit(365.0) / span),
        "historical_stockout_rate": as_double("historical_stockout_days")
        / F.greatest(F.col("observed_days"), F.lit(1)),
    })


def forecast_kpi(forecast: DataFrame) -> DataFrame:
    """Mean and total of each pair's forecast."""
    return forecast.groupBy(*SERIES).agg(
        F.avg("forecast_demand").alias("forecast_daily_demand"),
        F.sum("forecast_demand").alias("forecast_30_day_demand"))


def inventory_policy(profile: DataFrame, kpi: DataFrame | None = None,
                     z: float = SERVICE_Z) -> DataFrame:
    """Safety stock and reorder point; pairs without a forecast use their annual demand."""
    profile = materialise(profile)
    if kpi is None:
        joined = profile.withColumns({
            "forecast_daily_demand": F.lit(None).cast("double"),
            "forecast_30_day_demand": F.lit(None).cast("double")})
    else:
        joined = profile.join(kpi, SERIES, "left")
    typical = exact_median(profile, "demand_std").scalar()
    return joined.withColumns({
        "forecast_daily_demand": F.coalesce("forecast_daily_demand",
                                            F.col("annual_demand") / 365),
        "demand_std": F.coalesce(F.col("demand_std"), typical, F.lit(0.0)),
    }).withColumns({
        "forecast_30_day_demand": F.coalesce("forecast_30_day_demand",
                                             F.col("forecast_daily_demand") * CAP_DAYS),
        "safety_stock": z * F.col("demand_std")
        * F.sqrt(F.greatest(F.col("lead_time_days"), F.lit(1.0))),
        "expected_lead_time_demand": F.col("forecast_daily_demand") * F.col("lead_time_days"),
    }).withColumn("reorder_point", F.col("expected_lead_time_demand") + F.col("safety_stock"))


def economic_order_qty(policy: DataFrame, order_cost: float = ORDER_COST,
                       holding_rate: float = HOLDING_RATE) -> DataFrame:
    """Order size, capped by the 30-day demand; nothing to order above the reorder point."""
    holding = F.greatest(F.col("unit_price") * holding_rate, F.lit(0.01))
    size = F.sqrt(2 * F.greatest(F.col("annual_demand"), F.lit(1.0)) * order_cost / holding)
    due = F.col("current_stock") <= F.col("reorder_point")
    return policy.withColumn("eoq", size).withColumn(
        "recommended_order_qty",
        F.when(due, F.least("eoq", "forecast_30_day_demand")).otherwise(0.0))


def inventory_status(policy: DataFrame) -> DataFrame:
    """Status, shortage and coverage of the current stock."""
    stock = F.col("current_stock")
    days = stock / F.greatest(F.col("forecast_daily_demand"), F.lit(0.01))
    status = (
        F.when(stock <= F.col("safety_stock"), "CRITICAL")
        .when(stock <= F.col("reorder_point"), "REORDER").otherwise("NORMAL")
    )
    return policy.withColumns({
        "inventory_status": status,
        "shortage_to_rop": F.greatest(F.col("reorder_point") - stock, F.lit(0.0)),
        "days_of_stock": days,
        "current_stockout": (stock <= 0).cast("int"),
        "low_coverage_7d": (days < 7).cast("int"),
    })


def inventory_optimization(fact: DataFrame, forecast: DataFrame | None = None) -> DataFrame:
    """The whole table, rounded, by status name and then largest shortage."""
    kpi = None if forecast is None else forecast_kpi(forecast)
    table = inventory_status(economic_order_qty(inventory_policy(inventory_profile(fact), kpi)))
    return table.withColumns({c: round_to(c, 2) for c in ROUNDED}).orderBy(
        "inventory_status", F.desc("shortage_to_rop"), *SERIES)


def inventory_status_summary(inventory: DataFrame) -> DataFrame:
    """One row per status, beside the totals over all pairs."""
    per_status = inventory.groupBy("inventory_status").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("current_stockout").alias("stockouts"),
        F.sum("low_coverage_7d").alias("low_coverage"),
        F.sum("historical_stockout_rate").alias("rates"))
    everything = W.partitionBy()  # at most one row per status
    over_all = lambda name: F.sum(name).over(everything)
    return per_status.select(
        "inventory_status", "pairs",
        over_all("stockouts").alias("current_stockouts"),
        over_all("low_coverage").alias("low_coverage_pairs"), over_all("pairs").alias("all_pairs"),
        (100 * over_all("rates") / over_all("pairs")).alias("mean_stockout_rate_pct"))
