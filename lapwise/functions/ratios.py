"""Indicators, percentages and the numeric form handed to clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """``100 * part / whole``, rounded; NULL when ``whole`` is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def to_serving(df: DataFrame) -> DataFrame:
    """Every decimal column as double, for clients without a decimal type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
