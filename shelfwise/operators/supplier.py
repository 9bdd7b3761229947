"""Supplier service metrics and rule-based risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double, rank_of, right_closed, round_to


def supplier_metrics(fact: DataFrame) -> DataFrame:
    """Means and totals per supplier; nothing ordered counts as one unit ordered."""
    totals = fact.groupBy("supplier").agg(
        F.avg(as_double("lead_time_days")).alias("average_lead_time"),
        F.avg("on_time_rate").alias("on_time_rate"),
        F.avg("defect_rate").alias("defect_rate"),
        F.sum("supplier_delay").alias("total_supplier_delays"),
        F.sum("ordered_qty").alias("total_ordered"),
        F.sum("received_qty").alias("total_received"))
    ordered = F.when(F.col("total_ordered") == 0, 1).otherwise(F.col("total_ordered"))
    return totals.withColumn("fill_rate", as_double("total_received") / ordered).withColumns({
        "on_time_percentage": F.col("on_time_rate") * 100,
        "defect_percentage": F.col("defect_rate") * 100,
        "fill_percentage": F.col("fill_rate") * 100,
    })


def risk_index() -> Column:
    """Weighted late, defect and unfilled percentages of a metrics row, unrounded."""
    return (
        0.40 * (100 - F.col("on_time_percentage")) + 5 * 0.30 * F.col("defect_percentage")
        + 0.30 * (100 - F.col("fill_percentage"))
    )


def supplier_risk_score(metrics: DataFrame) -> DataFrame:
    """Risk score and level; the level comes from the unrounded score."""
    rounded = ["average_lead_time", "on_time_percentage", "defect_percentage", "fill_percentage",
               "risk_score"]
    return (
        metrics.withColumn("risk_score", risk_index())
        .withColumn("risk_level", right_closed("risk_score", [(10, "LOW"), (20, "MEDIUM")], "HIGH"))
        .withColumns({c: round_to(c, 2) for c in rounded})
    )


def supplier_risk_report(scored: DataFrame) -> DataFrame:
    """High risk first; inside a level by rising score."""
    return scored.orderBy(rank_of("risk_level", ["HIGH", "MEDIUM", "LOW"]), "risk_score",
                          "supplier")


def supplier_risk(fact: DataFrame) -> DataFrame:
    return supplier_risk_report(supplier_risk_score(supplier_metrics(fact)))
