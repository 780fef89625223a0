"""All registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lapwise.bindings import (
    oracle_star,
    oracle_storage,
    oracle_text,
    star_queries,
    storage_queries,
    text_queries,
)

from lapwise.session import tune, widen

Query = Callable[[SparkSession, str], DataFrame]


def _tuned(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(widen(tune(spark)), folder)

    return run


QUERIES: dict[str, Query] = {
    name: _tuned(query)
    for part in (star_queries, text_queries, storage_queries)
    for name, query in part.QUERIES.items()
}
ORACLE_SQL = {**oracle_star.QUERIES, **oracle_text.QUERIES, **oracle_storage.QUERIES}
