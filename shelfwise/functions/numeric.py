"""Column helpers for null-safe arithmetic, rounding and right-closed levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_double(value) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("double")


def ratio(numerator, denominator) -> Column:
    """Double division that yields NULL instead of failing on a zero denominator."""
    return as_double(numerator) / F.nullif(as_double(denominator), F.lit(0.0))


def ratio_or_zero(numerator, denominator) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def round_to(value, places: int) -> Column:
    """Round half away from zero; the nudge makes decimal ties independent of the engine."""
    column = as_double(value)
    # Adding zero turns a negative zero into zero.
    return F.round(column + F.signum(column) * F.lit(1e-9), places) + F.lit(0.0)


def right_closed(value, steps: list[tuple[float, str]], above: str) -> Column:
    """Label by ascending upper bounds, each bound belonging to the lower level."""
    column = F.col(value) if isinstance(value, str) else value
    bound, label = steps[0]
    chain = F.when(column <= bound, label)
    for bound, label in steps[1:]:
        chain = chain.when(column <= bound, label)
    return F.when(column.isNotNull(), chain.otherwise(above))


def rank_of(value, levels: list[str]) -> Column:
    """Position of a text level, for sorting; unknown levels go last."""
    column = F.col(value) if isinstance(value, str) else value
    place = F.array_position(F.array(*[F.lit(level) for level in levels]), column)
    return F.when(place > 0, place).otherwise(len(levels) + 1)


def missing_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL so that aggregates skip missing values."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
