"""Presentation views over the star.

Views that aggregate do so on the fact's foreign keys first and join dimensions to
the much smaller result.  Sums, minima and counts compose, so the answer is that of
join-then-group, while a race, driver or team holding a large share of the fact is
already collapsed map-side before any shuffle on its key.

No join is hinted: Spark broadcasts a dimension that its own statistics show to be small
and shuffles the others, whose skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapwise.functions import ascending, flag, percentage, year_boundaries
from lapwise.operators import ordered
from lapwise.plans.star import Star

# Fixed value: teams with fewer stops in a season are not ranked.
MIN_STOPS = 10


def race_result(star: Star) -> DataFrame:
    """Every result with its descriptions.  Only an unknown status keeps its row."""
    circuits = star.circuit.select(
        "circuit_id", "circuit_name", F.col("country").alias("circuit_country"),
        "latitude", "longitude",
    )
    drivers = star.driver.select(
        "driver_id", F.col("full_name").alias("driver_name"), "driver_code",
        F.col("nationality").alias("driver_nationality"),
    )
    return (
        star.result.join(star.race, "race_id")
        .join(circuits, "circuit_id")
        .join(drivers, "driver_id")
        .join(_teams(star), "constructor_id")
        .join(star.status, "status_id", "left")
        .select(
            "result_id", "season_year", "round_number", "race_name", "race_date",
            "circuit_name", "circuit_country", "latitude", "longitude", "driver_id",
            "driver_name", "driver_code", "driver_nationality", "constructor_id",
            "constructor_name", "status_description", "is_classified_finish",
            "retirement_category", "grid_position", "finish_position", "position_order",
            "points", "laps_completed", "positions_gained", "is_pit_lane_start", "is_win",
            "is_podium", "fastest_lap_ms", "fastest_lap_speed_kph",
        )
    )


def _teams(star: Star) -> DataFrame:
    teams = star.constructor.select("constructor_id", "constructor_name")
    return teams


def _placed_races(star: Star, season: int | None) -> DataFrame:
    """Races of the season (or all) whose circuit is known."""
    circuits = star.circuit.select("circuit_id")
    races = season_races(star, season).join(circuits, "circuit_id", "left_semi")
    return races


def of_season(star: Star, fact: DataFrame, season: int | None) -> DataFrame:
    """A fact cut to one season's races before it is joined or grouped."""
    if season is None:
        return fact
    return fact.join(season_races(star, season).select("race_id"), "race_id", "left_semi")


def season_races(star: Star, season: int | None) -> DataFrame:
    """Races of one season, or all; the season is cast to int, never spliced into SQL text."""
    return star.race if season is None else star.race.filter(F.col("season_year") == int(season))


def _entry_totals(
    star: Star, season: int | None, keys: tuple[str, ...], *measures: Column
) -> DataFrame:
    """The fact grouped on foreign keys, kept where race, driver and team are known."""
    drivers = star.driver.select("driver_id", "full_name", "driver_code")
    return (
        of_season(star, star.result, season)
        .groupBy("race_id", "driver_id", "constructor_id", *keys)
        .agg(*measures)
        .join(_placed_races(star, season), "race_id")
        .join(drivers, "driver_id")
        .join(_teams(star), "constructor_id")
    )


def running_points(star: Star, season: int | None = None) -> DataFrame:
    """Running points after each round, without the standing.

    Per driver the running frame holds one row per round and team, so it is bounded
    by the calendar.
    """
    per_round = (
        _entry_totals(
            star, season, (),
            F.sum("points").alias("points"),
            F.min("finish_position").alias("finish_position"),
        )
        .groupBy(
            "season_year", "round_number", "race_name", "race_date", "driver_id",
            F.col("full_name").alias("driver_name"), "driver_code", "constructor_name",
        )
        .agg(
            F.sum("points").alias("round_points"),
            F.min("finish_position").alias("finish_position"),
        )
    )
    order = [
        ascending(c) for c in ("round_number", "constructor_name", "race_date", "race_name")
    ]
    in_season = W.partitionBy("season_year", "driver_id").orderBy(*order)
    so_far = in_season.rowsBetween(W.unboundedPreceding, W.currentRow)
    return per_round.withColumns(
        {
            "cumulative_points": F.sum("round_points").over(so_far),
            "previous_round_finish": F.lag("finish_position", 1).over(in_season),
        }
    )


def season_progression(star: Star, season: int | None = None) -> DataFrame:
    """Running points and standing after each round, which ranks everybody in it, in slices."""
    return ordered.rank_by(
        running_points(star, season), ["season_year", "round_number"], "cumulative_points",
        "championship_position",
    ).select(
        "season_year", "round_number", "race_name", "race_date", "driver_id", "driver_name",
        "driver_code", "constructor_name", "round_points", "finish_position",
        "cumulative_points", "championship_position", "previous_round_finish",
    )


def pit_performance(
    star: Star,
    season: int | None = None,
    min_stops: int = MIN_STOPS,
) -> DataFrame:
    """Stop times per season and team: exact median, mean, minimum, 90th percentile.

    The two facts meet on race and driver, and stops are then counted once per season,
    team and millisecond; the fact's duration filter leaves at most 299,001 distinct
    values per team, so the exact percentiles read a bounded histogram.
    Percentiles are taken on whole milliseconds and rounded there, which is decimal
    rounding to three places of seconds.
    """
    stops = of_season(star, star.pit_stop, season).select("race_id", "driver_id", "duration_ms")
    entries = of_season(star, star.result, season).select(
        "race_id", "driver_id", "constructor_id"
    )
    races = season_races(star, season).select("race_id", "season_year")
    ms = F.col("duration_ms").cast("double")
    histogram = (
        stops.join(entries, ["race_id", "driver_id"])
        .join(races, "race_id")
        .groupBy("season_year", "constructor_id", "duration_ms")
        .agg(F.count("*").alias("weight"))
    )
    per_team = (
        histogram.groupBy("season_year", "constructor_id")
        .agg(
            F.sum("weight").alias("stop_count"),
            F.percentile(ms, 0.5, F.col("weight")).alias("median_ms"),
            F.percentile(ms, 0.9, F.col("weight")).alias("p90_ms"),
            F.sum(F.col("duration_ms") * F.col("weight")).alias("total_ms"),
            F.min("duration_ms").alias("fastest_ms"),
        )
        .join(_teams(star), "constructor_id")
        .filter(F.col("stop_count") >= min_stops)
    )
    ranked = ordered.rank_within(
        per_team, ["season_year"], "median_ms", "season_rank", largest_first=False
    )
    with_field = ordered.group_value(ranked, ["season_year"], {"field_ms": F.avg("median_ms")})

    def seconds(value: Column) -> Column:
        return F.round(value).cast("decimal(18,0)") / F.lit(1000).cast("decimal(4,0)")

    return with_field.select(
        "season_year", "constructor_id", "constructor_name", "stop_count",
        seconds(F.col("median_ms")).cast("decimal(18,3)").alias("median_stop_seconds"),
        seconds(F.col("total_ms") / F.col("stop_count"))
        .cast("decimal(18,3)")
        .alias("mean_stop_seconds"),
        seconds(F.col("fastest_ms")).cast("decimal(18,3)").alias("fastest_stop_seconds"),
        seconds(F.col("p90_ms")).cast("decimal(18,3)").alias("p90_stop_seconds"),
        "season_rank",
        seconds(F.col("median_ms") - F.col("field_ms"))
        .cast("decimal(18,3)")
        .alias("seconds_vs_field_median"),
    )


def reliability(star: Star, season: int | None = None) -> DataFrame:
    """Entries, classified finishes, retirements by cause and points per season and team."""
    category = F.col("retirement_category")

    def entries_where(condition: Column) -> Column:
        return F.sum(F.col("n") * flag(condition))

    return (
        _entry_totals(
            star, season, ("status_id",),
            F.count("*").alias("n"), F.sum("points").alias("points"),
        )
        .join(star.status, "status_id", "left")
        .groupBy("season_year", "constructor_name")
        .agg(
            F.sum("n").alias("entries"),
            entries_where(F.col("is_classified_finish")).alias("classified_finishes"),
            entries_where(category == "Mechanical").alias("mechanical_dnfs"),
            entries_where(category == "Incident").alias("incident_dnfs"),
            F.sum("points").alias("season_points"),
        )
        .select(
            "season_year", "constructor_name", "entries", "classified_finishes",
            percentage(F.col("classified_finishes"), F.col("entries")).alias("finish_rate_pct"),
            "mechanical_dnfs", "incident_dnfs", "season_points",
        )
    )


def season_summary(star: Star) -> DataFrame:
    """Rounds, drivers, teams and date span per season."""
    return (
        star.result.select("race_id", "driver_id", "constructor_id")
        .distinct()
        .join(_placed_races(star, None), "race_id")
        .join(star.driver.select("driver_id"), "driver_id", "left_semi")
        .join(_teams(star), "constructor_id", "left_semi")
        .groupBy("season_year")
        .agg(
            F.count_distinct("race_name").alias("rounds"),
            F.count_distinct("driver_id").alias("drivers"),
            F.count_distinct("constructor_id").alias("constructors"),
            F.min("race_date").alias("season_start"),
            F.max("race_date").alias("season_end"),
        )
    )


def driver_profile(star: Star, as_of: Column | None = None) -> DataFrame:
    """Driver facts with age in calendar years; mask it with ``operators.masking``."""
    today = F.current_date() if as_of is None else as_of
    return star.driver.select(
        "driver_id", "driver_ref", "driver_code", "full_name", "nationality", "date_of_birth",
        year_boundaries(F.col("date_of_birth"), today).alias("age_years"),
    )
