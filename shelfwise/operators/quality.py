"""Load-time gates on the daily fact: nulls, duplicates, numeric types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.numeric import missing_to_null
from shelfwise.functions.storage import materialise
from shelfwise.sources.schema import FACT, NUMERIC


def dq_null_check(df: DataFrame) -> DataFrame:
    """One row: number of null (or NaN) cells over all columns."""
    clean = missing_to_null(df)
    per_column = [F.count_if(F.col(c).isNull()) for c in clean.columns]
    total = per_column[0]
    for count in per_column[1:]:
        total = total + count
    return clean.agg(total.alias("null_cells"))


def dq_duplicate_check(df: DataFrame) -> DataFrame:
    """One row: number of rows that repeat an earlier identical row.

    Only an eight-byte hash per row is shuffled. Rows whose hash occurs more than once (none in a
    clean table) are then grouped on all columns, so an accidental hash match is not counted.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*df.columns))
    suspects = materialise(
        hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        .select("_hash"))
    copies = hashed.join(suspects, "_hash", "left_semi").groupBy(*df.columns).agg(
        F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def require_clean(df: DataFrame) -> DataFrame:
    """Raise when the fact has null cells or duplicate rows; else return it."""
    nulls = dq_null_check(df).first()["null_cells"]
    if nulls:
        raise ValueError(f"dataset contains {nulls} missing values")
    repeats = dq_duplicate_check(df).first()["duplicate_rows"]
    if repeats:
        raise ValueError(f"dataset contains {repeats} duplicate rows")
    return df


def _targets(columns) -> dict[str, T.DataType]:
    wanted = columns or NUMERIC
    return {f.name: f.dataType for f in FACT.fields if f.name in wanted}


def coerce_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Convert the named columns to their numeric types; text that is not a number raises."""
    strict = {}
    for name, kind in _targets(columns).items():
        number = F.col(name).try_cast(kind)
        problem = F.raise_error(F.concat(F.lit(f"{name} is not numeric: "), F.col(name)))
        strict[name] = (
            F.when(F.col(name).isNotNull() & number.isNull(), problem.cast(kind)).otherwise(number)
        )
    return df.withColumns(strict)


def numeric_errors(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: how many non-null cells are not numbers (nothing raises)."""
    targets = _targets(columns)
    counts = df.agg(*[
        F.count_if(F.col(n).isNotNull() & F.col(n).try_cast(k).isNull()).alias(n)
        for n, k in targets.items()
    ])
    return counts.unpivot([], list(targets), "column", "bad_cells")
