"""Sort keys under which NULL is the largest value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ascending(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.asc_nulls_last()


def descending(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.desc_nulls_first()
