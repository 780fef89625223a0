"""One audit row per table, file and load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT_KEY = ["target_table", "file_name", "last_load_time"]
COUNTERS = ("row_count", "error_count")


def load_history(rows: DataFrame, rejected: DataFrame) -> DataFrame:
    """Per-file load statistics of any number of tables in one grouping.

    ``rows`` has target_table, file_name, last_load_time; ``rejected`` also line_number
    and error_message.  Both sides are counted before they meet, so a file of any size
    shuffles as a handful of partial counts.
    """
    loaded = rows.groupBy(*AUDIT_KEY).agg(F.count("*").alias("row_count"))
    failed = rejected.groupBy(*AUDIT_KEY).agg(
        F.count("*").alias("error_count"),
        F.min_by("error_message", "line_number").alias("first_error_message"),
    )
    both = loaded.join(failed, AUDIT_KEY, "full_outer").fillna(0, list(COUNTERS))
    count, errors = F.col("row_count"), F.col("error_count")
    return both.select(
        *AUDIT_KEY,
        "row_count",
        (count + errors).alias("row_parsed"),
        "error_count",
        "first_error_message",
        F.when(errors == 0, "LOADED")
        .when(count == 0, "LOAD_FAILED")
        .otherwise("PARTIALLY_LOADED")
        .alias("load_status"),
    )


def with_empty_files(history: DataFrame, files: DataFrame, loaded_at: Column) -> DataFrame:
    """``history`` with a row for each of the ``files`` (target_table, file_name) it lacks."""
    # One file may be written with one or three slashes behind its scheme.
    name = F.regexp_replace("file_name", "^([a-z0-9]+):/+", "$1:/")
    seen = history.select(name.alias("__name")).distinct()
    empty = files.withColumn("__name", name).join(seen, "__name", "left_anti")
    return history.unionByName(
        empty.select(
            "target_table",
            "file_name",
            loaded_at.alias("last_load_time"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("row_count", "row_parsed", "error_count")],
            F.lit(None).cast("string").alias("first_error_message"),
            F.lit("LOADED").alias("load_status"),
        )
    )


def unrecorded(
    history: DataFrame, audit: DataFrame, now: Column, lookback_hours: int | None = None
) -> DataFrame:
    """History rows of the last hours that the audit does not hold yet."""
    if lookback_hours is not None:
        since = F.timestamp_add("HOUR", F.lit(-lookback_hours), now)
        history = history.filter(F.col("last_load_time") >= since)
    return history.join(audit.select(*AUDIT_KEY), AUDIT_KEY, "left_anti")


def latest(audit: DataFrame, count: int = 50) -> DataFrame:
    """Most recent audit rows; file name settles equal times."""
    return audit.orderBy(
        F.col("last_load_time").desc_nulls_first(),
        F.col("target_table").asc_nulls_last(),
        F.col("file_name").asc_nulls_last(),
    ).limit(count)


def rejects_per_table(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("target_table").agg(F.count("*").alias("reject_count"))


def table_counts(tables: dict[str, DataFrame], last_change: str | None = None) -> DataFrame:
    """One labelled row per table: row count and, if asked, the newest change time."""
    measures = {"row_count": F.count("*")}
    if last_change:
        measures["last_change"] = F.max(last_change)
    rows = [
        df.agg(*[m.alias(n) for n, m in measures.items()]).select(
            F.lit(name).alias("tbl"), *measures
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("tbl")
