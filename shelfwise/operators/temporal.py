"""Disruption signals of each (supplier, product) against its own recent past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.numeric import as_double, ratio, ratio_or_zero, right_closed
from shelfwise.sources.retail import require_columns

KEYS = ("supplier", "product")
MEASURES = ["lead_time", "on_time", "defect_rate", "fill_rate", "demand", "stockout"]
# Output name of the relative change -> measure.
RELATIVE = {"lead_time_pct_change": "lead_time", "fill_rate_pct_change": "fill_rate",
            "on_time_pct_change": "on_time", "defect_pct_change": "defect_rate"}
STAGES = [(20, "NORMAL"), (40, "EARLY_WARNING"), (70, "EMERGING")]


def temporal_daily(fact: DataFrame, keys=KEYS) -> DataFrame:
    """One row per key and day over all stores; partial sums keep a busy supplier cheap."""
    require_columns(fact, [*keys, "date", "lead_time_days", "on_time_rate", "defect_rate",
                           "ordered_qty", "received_qty", "demand", "stockout"])
    return fact.groupBy(*keys, "date").agg(
        F.avg(as_double("lead_time_days")).alias("lead_time"),
        F.avg("on_time_rate").alias("on_time"), F.avg("defect_rate").alias("defect_rate"),
        F.sum("ordered_qty").alias("ordered"), F.sum("received_qty").alias("received"),
        F.sum("demand").alias("demand"), F.avg(as_double("stockout")).alias("stockout"),
    ).withColumn("fill_rate", ratio_or_zero("received", "ordered"))


def temporal_baseline(daily: DataFrame, keys=KEYS, rows: int = 14, at_least: int = 5) -> DataFrame:
    """Mean of the previous rows (null with fewer than ``at_least``) and the change from it."""
    before = W.partitionBy(*keys).orderBy("date").rowsBetween(-rows, -1)

    def baseline(name: str) -> Column:
        return F.when(F.count(name).over(before) >= at_least, F.avg(as_double(name)).over(before))

    return daily.withColumns({f"{m}_baseline": baseline(m) for m in MEASURES}).withColumns(
        {f"{m}_change": F.col(m) - F.col(f"{m}_baseline") for m in MEASURES})


def temporal_pct_change(changes: DataFrame) -> DataFrame:
    """Relative changes; afterwards every missing number becomes zero."""
    relative = changes.withColumns({
        name: ratio(f"{m}_change", f"{m}_baseline") for name, m in RELATIVE.items()})
    numbers = [f.name for f in relative.schema.fields if isinstance(f.dataType, T.NumericType)]
    return relative.fillna(0, numbers)


def disruption_signal(changes: DataFrame) -> DataFrame:
    """Weighted deterioration between 0 and 100; improvements do not offset it."""
    worse = lambda column: F.greatest(column, F.lit(0.0))
    total = (
        35 * worse(F.col("lead_time_pct_change")) + 25 * worse(-F.col("fill_rate_pct_change"))
        + 20 * worse(-F.col("on_time_pct_change")) + 10 * worse(F.col("defect_pct_change"))
        + 10 * worse(F.col("stockout_change"))
    )
    return changes.withColumn(
        "disruption_signal", F.least(F.greatest(total, F.lit(0.0)), F.lit(100.0)))


def disruption_stage(signals: DataFrame) -> DataFrame:
    staged = signals.withColumn(
        "disruption_stage", right_closed("disruption_signal", STAGES, "CRITICAL"))
    return staged.withColumn(
        "is_disruption", F.col("disruption_stage").isin("EMERGING", "CRITICAL"))


def temporal_disruption(fact: DataFrame, keys=KEYS) -> DataFrame:
    """All steps from the fact to the staged signal."""
    return disruption_stage(disruption_signal(temporal_pct_change(
        temporal_baseline(temporal_daily(fact, keys), keys))))
