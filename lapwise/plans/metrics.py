"""Metrics attached to the typed tables, and their upkeep bucket by bucket."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.operators import quality
from lapwise.operators.tables import BUCKET, BucketTable
from lapwise.plans.star import MAX_STOP_MS, MIN_STOP_MS
from lapwise.session import stored

# Plausible grid slots and points of one entry.
GRID_RANGE = (0, 40)
POINTS_RANGE = (0, 50)

SHARES = T.StructType(
    [
        T.StructField("metric_name", T.StringType()),
        T.StructField("argument_names", T.StringType()),
        T.StructField("share", T.LongType()),
    ]
)


def suites(as_of: Column | None = None) -> dict[str, tuple[list[quality.Metric], list[list[str]]]]:
    """Metrics attached to each typed table, and the keys checked for duplicates."""
    return {
        "results": (
            [
                quality.null_count("race_id"),
                quality.null_count("driver_id"),
                quality.null_count("constructor_id"),
                quality.row_count(),
                quality.out_of_range(
                    "DMF_GRID_POSITION_OUT_OF_RANGE", "grid_position", *GRID_RANGE
                ),
                quality.out_of_range("DMF_POINTS_OUT_OF_RANGE", "points", *POINTS_RANGE),
            ],
            [["result_id"]],
        ),
        "drivers": ([quality.null_count("full_name")], [["driver_id"]]),
        "races": (
            [quality.null_count("season_year"), quality.freshness("dw_updated_at", as_of)],
            [["race_id"]],
        ),
        "pit_stops": (
            [
                quality.out_of_range(
                    "DMF_IMPLAUSIBLE_PIT_DURATION", "duration_ms", MIN_STOP_MS, MAX_STOP_MS
                )
            ],
            [["pit_stop_key"]],
        ),
    }


class BucketMetrics:
    """Each bucket's share of a table's metrics, so that a change costs its own buckets only.

    Counts add up over buckets.  So do rows beyond the first of a key, since a key always
    falls into the same bucket.  For freshness a bucket keeps its newest time.
    """

    def __init__(self, spark: SparkSession, path: str, name: str) -> None:
        self.table = BucketTable(spark, path, SHARES)
        self.name = name

    def update(self, rows: DataFrame, buckets: DataFrame, as_of: Column) -> None:
        """Measure the given ``buckets`` anew; ``rows`` are theirs."""
        metrics, unique = suites(as_of)[self.name]
        names = [f"m{i}" for i in range(len(metrics))]
        wide = rows.groupBy(BUCKET).agg(
            *[
                (F.unix_seconds(F.max(m.arguments)) if m.name == quality.FRESHNESS else m.measure())
                .cast("bigint").alias(n)
                for m, n in zip(metrics, names)
            ]
        )
        cells = [
            F.struct(
                F.lit(m.name).alias("metric_name"), F.lit(m.arguments).alias("argument_names"),
                F.col(n).alias("share"),
            )
            for m, n in zip(metrics, names)
        ]
        parts = [wide.select(BUCKET, F.inline(F.array(*cells)))]
        for key in unique:
            # Rows whose key's hash occurs once are no duplicates; only the others' keys are compared.
            digest = F.xxhash64(*key).alias("digest")
            twice = stored(
                rows.groupBy(BUCKET, digest).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "twice"
            )
            repeated = (
                rows.select(BUCKET, *key, digest).join(twice, [BUCKET, "digest"], "left_semi")
                .groupBy(BUCKET, *key).agg(F.count("*").alias("n")).groupBy(BUCKET)
            )
            counted = repeated.agg(F.sum(F.col("n") - 1).alias("share"))
            parts.append(
                # A bucket without any has a row that says so.
                wide.select(BUCKET, F.lit(0).cast("bigint").alias("share")).unionByName(counted)
                .groupBy(BUCKET).agg(F.sum("share").alias("share"))
                .select(
                    BUCKET, F.lit(quality.DUPLICATE_COUNT).alias("metric_name"),
                    F.lit(",".join(key)).alias("argument_names"), "share",
                )
            )
        self.table.replace(reduce(DataFrame.unionByName, parts), buckets)

    def totals(self, as_of: Column) -> DataFrame:
        """The table's metrics as rows of the history, out of the stored shares."""
        value = F.when(
            F.col("metric_name") == quality.FRESHNESS, F.unix_seconds(as_of) - F.max("share")
        ).otherwise(F.coalesce(F.sum("share"), F.lit(0)))
        return (
            self.table.read()
            .groupBy("metric_name", "argument_names")
            .agg(value.cast("bigint").alias("metric_value"))
            .select(
                F.lit(self.name).alias("table_name"), "metric_name", "argument_names",
                "metric_value", as_of.alias("measurement_time"),
            )
        )
