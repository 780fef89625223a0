"""Table metrics, referential checks and verdicts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import descending
from lapwise.operators.ordered import newest

# Metric names and the conditions under which a value is a breach.
DUPLICATE_COUNT = "DUPLICATE_COUNT"
NULL_COUNT = "NULL_COUNT"
ROW_COUNT = "ROW_COUNT"
FRESHNESS = "FRESHNESS"
CUSTOM_PATTERN = "DMF_%"

RESULT_KEY = ["table_name", "metric_name", "argument_names"]
RESULT = (
    "table_name string, metric_name string, argument_names string, metric_value bigint, "
    "measurement_time timestamp"
)


@dataclass(frozen=True)
class Metric:
    """A named number computed from one table in a single aggregation."""

    name: str
    arguments: str
    measure: Callable[[], Column]


def null_count(column: str) -> Metric:
    return Metric(NULL_COUNT, column, lambda: F.count_if(F.col(column).isNull()))


def row_count() -> Metric:
    return Metric(ROW_COUNT, "", lambda: F.count("*"))


def out_of_range(name: str, column: str, low: float, high: float) -> Metric:
    """Rows whose value lies outside ``low..high``; NULL is no violation."""
    value = column
    return Metric(
        name, column, lambda: F.count_if((F.col(value) < low) | (F.col(value) > high))
    )


def freshness(column: str, as_of: Column | None = None) -> Metric:
    """Seconds between the newest value and ``as_of``."""

    def measure() -> Column:
        now = F.current_timestamp() if as_of is None else as_of
        return (
            F.unix_seconds(now.cast("timestamp"))
            - F.unix_seconds(F.max(column).cast("timestamp"))
        )

    return Metric(FRESHNESS, column, measure)


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, as one row; counted map-side before the shuffle."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("metric_value")
    )


def measure_table(
    name: str,
    df: DataFrame,
    metrics: Sequence[Metric],
    unique: Sequence[Sequence[str]] = (),
    measured_at: Column | None = None,
) -> DataFrame:
    """All metrics of a table as rows: one pass for the plain ones, one grouping per key."""
    names = [f"m{i}" for i in range(len(metrics))]
    wide = df.agg(*[m.measure().cast("bigint").alias(n) for m, n in zip(metrics, names)])
    cells = [
        F.struct(
            F.lit(m.name).alias("metric_name"),
            F.lit(m.arguments).alias("argument_names"),
            F.col(n).alias("metric_value"),
        )
        for m, n in zip(metrics, names)
    ]
    parts = [wide.select(F.inline(F.array(*cells)))] if metrics else []
    parts += [
        duplicate_count(df, key).select(
            F.lit(DUPLICATE_COUNT).alias("metric_name"),
            F.lit(",".join(key)).alias("argument_names"),
            F.col("metric_value").cast("bigint").alias("metric_value"),
        )
        for key in unique
    ]
    now = F.current_timestamp() if measured_at is None else measured_at
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(name).alias("table_name"),
        "metric_name",
        "argument_names",
        "metric_value",
        now.cast("timestamp").alias("measurement_time"),
    )


def verdict(metric: Column, value: Column) -> Column:
    return (
        F.when(metric.isin(DUPLICATE_COUNT, NULL_COUNT) & (value > 0), "BREACH")
        .when(metric.like(CUSTOM_PATTERN) & (value > 0), "BREACH")
        .when((metric == ROW_COUNT) & (value == 0), "BREACH")
        .otherwise("OK")
    )


def latest_results(history: DataFrame) -> DataFrame:
    """Newest measurement of every metric with its verdict."""
    return newest(
        history, RESULT_KEY, [descending("measurement_time"), descending("metric_value")]
    ).withColumn("status", verdict(F.col("metric_name"), F.col("metric_value")))


class QualityBreach(RuntimeError):
    """Raised by ``enforce``; ``breaches`` is the frame of all metrics in breach."""

    def __init__(self, count: int, breaches: DataFrame) -> None:
        super().__init__(f"{count} metrics in breach")
        self.count = count
        self.breaches = breaches


def enforce(latest: DataFrame) -> None:
    """Optional gate: measuring alone never stops a run."""
    breaches = latest.filter(F.col("status") == "BREACH")
    count = breaches.count()
    if count:
        raise QualityBreach(count, breaches)


def orphan_count(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None
) -> DataFrame:
    """Child rows whose key is absent from the parent; a NULL key counts.

    Keys are counted first, so a key (or NULL) shared by any number of rows reaches
    the anti-join once.
    """
    keys = child.groupBy(F.col(child_key).alias("__key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key or child_key).alias("__key"))
    return keys.join(known, "__key", "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count")
    )


def integrity(
    checks: Sequence[tuple[str, DataFrame, DataFrame, str, str]],
) -> DataFrame:
    """One row per (label, child, parent, child key, parent key)."""
    parts = [
        orphan_count(child, parent, ck, pk).select(F.lit(label).alias("relationship"), "orphan_count")
        for label, child, parent, ck, pk in checks
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("relationship")
