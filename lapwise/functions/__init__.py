"""Column expressions shared by every layer.  All of them stay inside Catalyst."""

from lapwise.functions.casts import (
    duration_to_ms,
    try_date,
    try_decimal,
    try_double,
    try_int,
    try_number,
    try_time,
)
from lapwise.functions.dates import day_name, first_of_year, year_boundaries
from lapwise.functions.hashing import change_hash, exact_hash
from lapwise.functions.ordering import ascending, descending
from lapwise.functions.ratios import flag, percentage, to_serving

__all__ = [
    "ascending",
    "change_hash",
    "day_name",
    "descending",
    "duration_to_ms",
    "exact_hash",
    "first_of_year",
    "flag",
    "percentage",
    "to_serving",
    "try_date",
    "try_decimal",
    "try_double",
    "try_int",
    "try_number",
    "try_time",
    "year_boundaries",
]
