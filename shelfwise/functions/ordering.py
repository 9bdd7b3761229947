"""Running sums, row numbers, medians and percentile ranks over one total order.

A window without ``partitionBy`` would pull the whole table into one task. Here the rows are
range-partitioned by the order, each slice is summed on its own, and the totals of the slices
before it are added. The table of slice totals has one row per shuffle partition, which is the
bound that allows the broadcast and the one un-partitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.functions.storage import materialise


def running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Add ``name`` (sum up to and including the row) and ``name_total`` for each entry of sums.

    ``order`` must be unique per row.
    """
    inputs = {f"_in_{name}": column for name, column in sums.items()}
    sliced = materialise(
        df.withColumns(inputs)
        .repartitionByRange(*order)
        .withColumn("_slice", F.spark_partition_id())
    )
    earlier = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    slices = sliced.groupBy("_slice").agg(
        *[F.sum(f"_in_{name}").alias(f"_sum_{name}") for name in sums]
    ).select(
        "_slice",
        *[F.sum(f"_sum_{name}").over(earlier).alias(f"_before_{name}") for name in sums],
        *[F.sum(f"_sum_{name}").over(everything).alias(f"{name}_total") for name in sums],
    )
    within = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return (
        sliced.withColumns({name: F.sum(f"_in_{name}").over(within) for name in sums})
        .join(F.broadcast(slices), "_slice")
        .withColumns({
            name: F.when(F.col(f"_before_{name}").isNull(), F.col(name))
            .otherwise(F.col(name) + F.col(f"_before_{name}"))
            for name in sums
        })
        .drop("_slice", *inputs, *[f"_before_{name}" for name in sums])
    )


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Row number 1..n (BIGINT) over a unique order."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}).drop(f"{name}_total")


def exact_median(df: DataFrame, column: str) -> DataFrame:
    """One row: the exact median of the non-null values, NULL when there are none."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("copies"))
    )
    placed = running_totals(counted, [F.col("value")], {"upto": F.col("copies")})
    # Ranks of the two middle values (equal when the count is odd).
    low = F.floor((F.col("upto_total") + 1) / 2)
    high = F.floor((F.col("upto_total") + 2) / 2)
    first = F.col("upto") - F.col("copies") + 1
    share = (
        F.when(low.between(first, F.col("upto")), 0.5).otherwise(0.0)
        + F.when(high.between(first, F.col("upto")), 0.5).otherwise(0.0)
    )
    return placed.withColumn("share", share).where("share > 0").agg(
        F.sum(F.col("value") * F.col("share")).alias("median")
    )


def percentile_ranks(df: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    """Average-tie percentile rank of each measure; returns keys and one column per measure.

    ``df`` must be materialised (the values are joined back by equality) and unique on ``keys``.
    Equal values are counted before the sort, so a value shared by many rows stays one row.
    """
    names = list(measures)
    stacked = df.select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("measure"), measures[n].cast("double").alias("value"))
            for i, n in enumerate(names)
        ])).alias("m"),
    ).select(*keys, "m.measure", "m.value")
    counted = (
        stacked.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("measure", "value").agg(F.count(F.lit(1)).alias("copies"))
    )
    placed = running_totals(
        counted, [F.col("measure"), F.col("value")],
        {f"upto_{i}": F.when(F.col("measure") == i, F.col("copies")).otherwise(F.lit(0).cast("long"))
         for i in range(len(names))},
    )
    own = F.array(*[F.col(f"upto_{i}") for i in range(len(names))])[F.col("measure")]
    size = F.array(*[F.col(f"upto_{i}_total") for i in range(len(names))])[F.col("measure")]
    ranked = placed.select(
        "measure", "value",
        ((own - F.col("copies") + (F.col("copies") + 1) / 2) / size).alias("pct"),
    )
    return (
        stacked.join(ranked, ["measure", "value"], "left")
        .groupBy(*keys)
        .agg(*[F.max(F.when(F.col("measure") == i, F.col("pct"))).alias(n)
               for i, n in enumerate(names)])
    )


def pct_rank(df: DataFrame, column: str, ascending: bool = True,
             name: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Add the average-tie percentile rank (rank / n) of one column; NULL stays NULL."""
    name = name or f"{column}_pct_rank"
    base = materialise(df)
    keys = keys or [c for c in df.columns if c != column]
    value = F.col(column) if ascending else -F.col(column)
    return base.join(percentile_ranks(base, keys, {name: value}), keys)
