"""Rows that carry a usable vector, for the operators on vectors of whole numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import pick


def usable(vectors: DataFrame, id_col: str, vector_col: str, *others: str) -> DataFrame:
    """``vec_id, vector`` (doubles) and ``others`` of the rows with a whole, finite vector.

    Null and empty vectors and those with a null or non-finite entry are left out.
    """
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        pick(vectors, id_col, vector_col, *others)
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
            *others,
        )
        .where(F.col("vector").isNotNull() & (F.size("vector") > 0))
        .where(F.coalesce(finite, F.lit(False)))
    )


def common_length(rows: DataFrame) -> int:
    """The most frequent length of ``vector``, of equally frequent ones the greater; 0 without rows."""
    counts = rows.groupBy(F.size("vector").alias("size")).count()
    first = counts.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def grid(scale: int, shift: int = 0, limit: int = 1 << 62) -> tuple[Column, Column]:
    """``floor(scale * entry) + shift`` of every entry, and whether all lie within ``limit``."""
    inside = F.forall("vector", lambda c: F.abs(c * F.lit(float(scale))) <= F.lit(float(limit)))
    whole = F.transform("vector", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("long"))
    return whole, inside
