"""Frames behind the dashboard; decimals leave as doubles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions import ascending, descending, to_serving
from lapwise.operators import ordered
from lapwise.plans import views
from lapwise.plans.star import Star

# Lines on the progression chart, and the name shown for an empty season.
CONTENDERS = 6
NO_CHAMPION = "—"


def seasons(star: Star) -> DataFrame:
    return to_serving(
        views.season_summary(star)
        .filter(F.col("rounds") > 0)
        .select("season_year", "rounds", "drivers", "constructors")
        .orderBy(descending("season_year"))
    )


def progression(star: Star, season: int | None = None) -> DataFrame:
    return to_serving(
        views.season_progression(star, season)
        .orderBy(
            *[
                ascending(c)
                for c in ("season_year", "round_number", "championship_position", "driver_id")
            ]
        )
        .select(
            "season_year", "round_number", "race_name", "driver_name", "driver_code",
            "constructor_name", "round_points", "cumulative_points", "championship_position",
        )
    )


def pit_performance(
    star: Star, season: int | None = None, min_stops: int = views.MIN_STOPS
) -> DataFrame:
    return to_serving(
        views.pit_performance(star, season, min_stops)
        .orderBy(
            ascending("season_year"), ascending("season_rank"), ascending("constructor_name")
        )
        .select(
            "season_year", "constructor_name", "stop_count", "median_stop_seconds",
            "p90_stop_seconds", "fastest_stop_seconds", "season_rank",
            "seconds_vs_field_median",
        )
    )


def reliability(star: Star, season: int | None = None) -> DataFrame:
    return to_serving(
        views.reliability(star, season)
        .orderBy(
            ascending("season_year"), descending("season_points"), ascending("constructor_name")
        )
        .select(
            "season_year", "constructor_name", "entries", "finish_rate_pct", "mechanical_dnfs",
            "incident_dnfs", "season_points",
        )
    )


def _finals(rows: DataFrame) -> DataFrame:
    """Points of each driver name after their last round of each season, and that round.

    The last known total is wanted, so rows without one are passed over.
    """
    # The latest round first, then the greatest team name, an unknown one counting as such.
    last = F.struct("round_number", F.col("constructor_name").isNull(), "constructor_name")
    known = F.when(F.col("cumulative_points").isNotNull(), last)
    return rows.groupBy("season_year", "driver_name").agg(
        F.max_by("cumulative_points", known).alias("cumulative_points"),
        F.max("round_number").alias("rounds"),
    )


def _best(finals: DataFrame, count: int) -> DataFrame:
    known = finals.filter(F.col("cumulative_points").isNotNull())
    order = [descending("cumulative_points"), ascending("driver_name")]
    return ordered.top_per_group(known, ["season_year"], order, count)


def top_contenders(rows: DataFrame, count: int = CONTENDERS) -> DataFrame:
    """All rounds of the ``count`` best drivers of each season; names settle ties."""
    best = _best(_finals(rows), count).select("season_year", "driver_name")
    return rows.join(best, ["season_year", "driver_name"], "left_semi")


def title_margin(rows: DataFrame) -> DataFrame:
    """Champion, points, lead over the runner-up and rounds held, per season.

    With a single driver the lead is their own total.
    """
    finals = _finals(rows)
    best_two = _best(finals, 2)
    points = F.col("cumulative_points")
    # Largest total first, then the first name: the smallest (negated total, name).
    place = F.struct((-points).alias("behind"), F.col("driver_name").alias("name"))
    totals = best_two.groupBy("season_year").agg(
        F.min_by("driver_name", place).alias("champion"),
        F.max(points).alias("points"),
        F.min(points).alias("second"),
        F.count("*").alias("drivers"),
    )
    rounds = finals.groupBy("season_year").agg(F.max("rounds").alias("rounds"))
    margin = F.when(F.col("drivers") > 1, F.col("points") - F.col("second")).otherwise(
        F.col("points")
    )
    return to_serving(
        totals.join(rounds, "season_year")
        .select("season_year", "champion", "points", margin.alias("margin"), "rounds")
    )


def season_headline(rows: DataFrame, season: int) -> DataFrame:
    """One row for a season, also when it has no results."""
    found = title_margin(rows.filter(F.col("season_year") == int(season))).drop("season_year")
    # Grouped without keys, an empty season still is one row.
    return found.agg(
        F.coalesce(F.first("champion"), F.lit(NO_CHAMPION)).alias("champion"),
        F.coalesce(F.first("points"), F.lit(0.0)).alias("points"),
        F.coalesce(F.first("margin"), F.lit(0.0)).alias("margin"),
        F.coalesce(F.first("rounds"), F.lit(0)).alias("rounds"),
    )
