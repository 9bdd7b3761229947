"""Read the daily fact and optional result tables; write result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.schema import FACT


def read_retail_daily(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Read the 25-column daily fact with its declared types (no inference pass)."""
    if format not in ("csv", "parquet"):
        raise ValueError(f"unsupported format: {format}")
    reader = spark.read.schema(FACT)
    if format == "csv":
        # A value that does not fit its type fails the job instead of becoming NULL.
        return reader.option("header", True).option("mode", "FAILFAST").csv(path)
    return reader.parquet(path)


def read_optional(spark: SparkSession, path: str, schema: T.StructType,
                  format: str = "parquet") -> DataFrame:
    """Read a result table; a path that does not exist gives an empty table."""
    try:
        reader = spark.read.schema(schema)
        return reader.option("header", True).csv(path) if format == "csv" else reader.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_artifact(df: DataFrame, path: str, format: str = "parquet",
                   mode: str = "overwrite") -> None:
    """Write a result table as it is partitioned; CSV gets a header."""
    writer = df.write.mode(mode)
    if format == "csv":
        writer.option("header", True).csv(path)
    elif format == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format: {format}")


def require_columns(df: DataFrame, required) -> DataFrame:
    """Fail with the sorted list of missing columns; metadata only, no job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def fallback_column(df: DataFrame, name: str, fallback: Column) -> Column:
    """The named column when the table has it, else the substitute expression."""
    return F.col(name) if name in df.columns else fallback
