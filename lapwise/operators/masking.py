"""Column masking by role, and by tag."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import first_of_year

# The sensitivity tag, its allowed values, and the role that sees dates.
TAG = "data_sensitivity"
ALLOWED_TAGS = ("PUBLIC", "INTERNAL", "PII")
PRIVILEGED_ROLES = frozenset({"engineer"})

Mask = Callable[[Column, bool], Column]


def mask_date(value: Column, privileged: bool) -> Column:
    """The date itself for a privileged caller, else 1 January of its year."""
    return value if privileged else first_of_year(value)


def tag(df: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Record a sensitivity tag in the metadata of the named columns."""
    for column, value in tags.items():
        if value not in ALLOWED_TAGS:
            raise ValueError(f"{value!r} is not one of {ALLOWED_TAGS}")
        metadata = {**df.schema[column].metadata, TAG: value}
        df = df.withMetadata(column, metadata)
    return df


def tagged_columns(df: DataFrame, value: str = "PII") -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get(TAG) == value]


def is_privileged(roles: Iterable[str]) -> bool:
    """Any held role counts, not only the primary one."""
    return bool(PRIVILEGED_ROLES.intersection(roles))


def apply_masks(df: DataFrame, masks: Mapping[str, Mask], roles: Iterable[str]) -> DataFrame:
    """Mask every tagged column for a caller holding ``roles``.

    The mask is part of the returned plan: an unprivileged frame has no column from
    which the original value could be read.
    """
    privileged = is_privileged(roles)
    columns = []
    for f in df.schema.fields:
        mask = masks.get(f.metadata.get(TAG, ""))
        column = F.col(f"`{f.name}`")
        if mask is not None:
            column = mask(column, privileged).alias(f.name, metadata=f.metadata)
        columns.append(column)
    return df.select(*columns)
