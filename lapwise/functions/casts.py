"""Casts from text that yield NULL on a bad value instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a clock time with one or two hour digits.
CLOCK_PATTERN = r"^([01]?[0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"

# Fixed value: a decimal number, without type suffix, hexadecimal or named values.
REAL_PATTERN = r"^\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def try_number(value: Column | str) -> Column:
    """Whole number; fractions round half up, out-of-range text becomes NULL.

    Plain digits take the cheap integer cast; only other text is read as a decimal.
    """
    text = _column(value)
    return F.coalesce(
        text.try_cast("bigint"), text.try_cast("decimal(38,0)").try_cast("bigint")
    )


def try_int(value: Column | str) -> Column:
    text = _column(value)
    return F.coalesce(text.try_cast("int"), text.try_cast("decimal(38,0)").try_cast("int"))


def try_double(value: Column | str) -> Column:
    text = _column(value).cast("string")
    return F.when(text.rlike(REAL_PATTERN), text.try_cast("double"))


def try_decimal(value: Column | str, precision: int = 8, scale: int = 2) -> Column:
    return _column(value).try_cast(f"decimal({precision},{scale})")


def try_date(value: Column | str) -> Column:
    return F.try_to_date(_column(value), "yyyy-MM-dd")


def try_time(value: Column | str) -> Column:
    """Clock time as canonical ``HH:mm:ss`` text, independent of the session zone."""
    text = F.trim(_column(value))
    return F.when(text.rlike(CLOCK_PATTERN), F.lpad(text, 8, "0"))


def duration_to_ms(value: Column | str) -> Column:
    """``m:ss.SSS`` or ``ss.SSS`` to whole milliseconds; parts after a second colon are ignored."""
    text = _column(value)
    minutes = try_number(F.split_part(text, F.lit(":"), F.lit(1)))
    seconds = try_double(F.split_part(text, F.lit(":"), F.lit(2)))
    with_minutes = F.try_add(
        F.try_multiply(minutes, F.lit(60000)), F.round(seconds * 1000).try_cast("bigint")
    )
    plain = F.round(try_double(text) * 1000).try_cast("bigint")
    return F.when(F.position(F.lit(":"), text) > 0, with_minutes).otherwise(plain)
