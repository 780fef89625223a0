"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_name(date: Column | str) -> Column:
    """Three-letter day name (``Mon`` .. ``Sun``)."""
    return F.dayname(date)


def year_boundaries(start: Column, end: Column) -> Column:
    """Number of year ends crossed, not of full years elapsed."""
    return F.year(end) - F.year(start)


def first_of_year(date: Column) -> Column:
    return F.make_date(F.year(date), F.lit(1), F.lit(1))
