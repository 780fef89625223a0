"""Row fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field separator and NULL marker of the text fingerprint.
SEPARATOR = "||"
NULL_MARK = "~"


def change_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as text, NULL written as a marker.

    ``concat_ws`` skips NULLs, so they are marked first: otherwise a value moving
    from one column to its neighbour would look unchanged.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def exact_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the columns as one JSON object; no text can forge a separator or marker."""
    record = F.struct(*[F.col(c) for c in columns])
    return F.sha2(F.to_json(record, {"ignoreNullFields": "false"}), 256)
