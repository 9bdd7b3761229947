"""Daily demand series and leak-free features.

Series are summed to one row per key and day before any window, so a window partition holds at
most one row per calendar day whatever the fact holds for that key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.numeric import as_double

SERIES = ["store", "product"]
LAGS = (1, 7, 14, 30)
# Fixed feature order of the store-product model.
FEATURES = ["lag_1", "lag_7", "lag_14", "lag_30", "rolling_mean_7", "rolling_mean_30",
            "rolling_std_7", "day_of_week", "month", "day_of_month", "is_weekend",
            "promo_event", "discount_pct"]
# The network model uses the mean discount of the day instead.
NETWORK_FEATURES = FEATURES[:-1] + ["average_discount"]
MIN_HISTORY = 60
HOLD_OUT_DAYS = 60


def daily_demand(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*SERIES, "date").agg(F.sum("demand").alias("demand"))


def daily_demand_drivers(fact: DataFrame) -> DataFrame:
    """Daily demand with promotions, mean discount and mean list price."""
    return fact.groupBy(*SERIES, "category", "date").agg(
        F.sum("demand").alias("demand"), F.sum("promo_event").alias("promo_event"),
        F.avg("discount_pct").alias("discount_pct"),
        F.avg(as_double("unit_price")).alias("unit_price"))


def network_daily_demand(fact: DataFrame) -> DataFrame:
    """All stores and products together, one row per day."""
    return fact.groupBy("date").agg(
        F.sum("demand").alias("demand"), F.sum("promo_event").alias("promo_event"),
        F.avg("discount_pct").alias("average_discount"))


def _in_date_order(keys) -> WindowSpec:
    # Without keys this is the network series: one row per day in one window.
    return (W.partitionBy(*keys) if keys else W.partitionBy()).orderBy("date")


def demand_lags(daily: DataFrame, lags=LAGS, keys=SERIES) -> DataFrame:
    """Demand of the n-th row before, within the series (rows, not calendar days)."""
    series = _in_date_order(keys)
    return daily.withColumns({f"lag_{n}": F.lag("demand", n).over(series) for n in lags})


def demand_rolling(daily: DataFrame, keys=SERIES) -> DataFrame:
    """Means of the 7 and 30 rows before and deviation of 7; null until the window is full."""
    series = _in_date_order(keys)

    def before(rows: int, aggregate: Column) -> Column:
        window = series.rowsBetween(-rows, -1)
        full = F.count("demand").over(window) == rows
        return F.when(full, aggregate.over(window))

    return daily.withColumns({
        "rolling_mean_7": before(7, F.avg("demand")),
        "rolling_mean_30": before(30, F.avg("demand")),
        "rolling_std_7": before(7, F.stddev_samp("demand")),
    })


def calendar_features(df: DataFrame) -> DataFrame:
    """Weekday (Monday 0), month, day of month, weekend flag."""
    return df.withColumns({
        "day_of_week": F.weekday("date"), "month": F.month("date"),
        "day_of_month": F.dayofmonth("date"),
        "is_weekend": (F.weekday("date") >= 5).cast("int"),
    })


def demand_features(daily: DataFrame, keys=SERIES) -> DataFrame:
    return calendar_features(demand_rolling(demand_lags(daily, keys=keys), keys))


def forecast_training_set(daily: DataFrame, min_history: int = MIN_HISTORY) -> DataFrame:
    """Feature rows of the series with more than ``min_history`` rows and no null feature."""
    history = F.count(F.lit(1)).over(W.partitionBy(*SERIES))
    return (
        demand_features(daily).withColumn("_history", history)
        .where(F.col("_history") > min_history).drop("_history").dropna(subset=FEATURES)
    )


def temporal_split(df: DataFrame, days: int = HOLD_OUT_DAYS) -> DataFrame:
    """Add ``split``: rows up to ``days`` before the last date are train, later rows test."""
    cutoff = F.date_sub(df.agg(F.max("date")).scalar(), days)
    return df.withColumn("split", F.when(F.col("date") <= cutoff, "train").otherwise("test"))


def train_and_test(df: DataFrame, days: int = HOLD_OUT_DAYS) -> tuple[DataFrame, DataFrame]:
    """The two sides of the temporal split; raises when one is empty."""
    labelled = temporal_split(df, days)
    train, test = (labelled.where(F.col("split") == side).drop("split")
                   for side in ("train", "test"))
    if train.isEmpty() or test.isEmpty():
        raise ValueError("temporal split produced an empty train or test set")
    return train, test


def pair_coverage(df: DataFrame) -> DataFrame:
    """One row: number of distinct (store, product) pairs."""
    return df.select(*SERIES).distinct().agg(F.count(F.lit(1)).alias("sku_store_pairs"))


def walk_forward_folds(data: DataFrame, n_folds: int = 4, min_frac: float = 0.6) -> DataFrame:
    """Expanding folds over a one-row-per-day table: columns ``fold`` and ``role`` are added."""
    numbered = data.withColumns({
        "_row": F.row_number().over(W.orderBy("date")),
        "_rows": F.count(F.lit(1)).over(W.partitionBy()),
    })
    start = F.floor(F.col("_rows") * F.lit(min_frac))
    size = F.greatest(F.lit(1).cast("long"), F.floor((F.col("_rows") - start) / n_folds))
    folds = numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_folds))))
    train_end = start + (F.col("fold") - 1) * size
    test_end = F.least(F.col("_rows"), train_end + size)
    role = F.when(F.col("_row") <= train_end, "train").when(F.col("_row") <= test_end, "test")
    return (
        folds.withColumn("role", role)
        .where(F.col("role").isNotNull() & (test_end > train_end)).drop("_row", "_rows")
    )
