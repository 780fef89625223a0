"""The analyst questions, each over one season, a span of seasons, or all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.functions import ascending, descending, percentage
from lapwise.operators import ordered
from lapwise.operators.pairs import head_to_head
from lapwise.plans import views
from lapwise.plans.star import Star

# Defaults of the analyst questions.
STANDINGS_SIZE = 20
FORM_RACES = 5
MIN_SHARED_RACES = 5
MIN_DROUGHT = 20
LONGEST_DROUGHTS = 15


def season_shape(star: Star, since: int | None = None) -> DataFrame:
    summary = views.season_summary(star)
    if since is not None:
        summary = summary.filter(F.col("season_year") >= int(since))
    return summary.orderBy(descending("season_year"))


def classification(
    results: DataFrame, season: int | None = None, race_name: str | None = None
) -> DataFrame:
    """Full classification of one race, or of every race in calendar order."""
    if season is not None:
        results = results.filter(F.col("season_year") == int(season))
    if race_name is not None:
        results = results.filter(F.col("race_name") == race_name)
    return results.orderBy(
        *[ascending(c) for c in ("season_year", "round_number", "position_order", "result_id")]
    ).select(
        "season_year", "race_name", "finish_position", "driver_id", "driver_name",
        "constructor_name", "grid_position", "positions_gained", "points", "status_description",
    )


def final_rows(progression: DataFrame) -> DataFrame:
    """Each driver's last row of each season."""
    return ordered.newest(
        progression,
        ["season_year", "driver_id"],
        [descending("round_number"), ascending("constructor_name")],
    )


def final_standings(progression: DataFrame, size: int = STANDINGS_SIZE) -> DataFrame:
    """Top of the table per season.

    A driver keeps the standing of their own last round; the driver key settles
    equal standings, which occur when drivers stopped in different rounds.
    """
    order = [ascending("championship_position"), ascending("driver_id")]
    return (
        ordered.top_per_group(final_rows(progression), ["season_year"], order, size)
        .orderBy(ascending("season_year"), *order)
        .select(
            "season_year", "championship_position", "driver_id", "driver_name",
            "constructor_name", "cumulative_points",
        )
    )


def leader_gap(progression: DataFrame) -> DataFrame:
    """The two best running totals of every round and the gap to the leader.

    The two totals are found among distinct values, two rows per round, and joined back,
    so any number of drivers level on points is spread over the cluster.
    """
    rounds = ["season_year", "round_number"]
    points = F.col("cumulative_points")
    totals = progression.select(*rounds, "cumulative_points").distinct()
    leading = ordered.top_per_group(totals, rounds, [descending(points)], 2)
    best = ordered.group_value(leading, rounds, {"leader_points": F.max(points)})
    leaders = ordered.null_safe_join(progression, best, [*rounds, "cumulative_points"])
    return leaders.select(
        *rounds, "race_name", "driver_id", "driver_name", "cumulative_points",
        (F.col("leader_points") - points).alias("points_behind_leader"),
    ).orderBy(*[ascending(c) for c in rounds], descending(points), ascending("driver_id"))


def rolling_form(
    results: DataFrame,
    races: int = FORM_RACES,
    order: Sequence[str] = ("race_date", "result_id"),
    chunk_rows: int = ordered.CHUNK_ROWS,
) -> DataFrame:
    """Average finish over a driver's last ``races`` finishes, with the frame's row count."""
    finished = results.filter(F.col("finish_position").isNotNull()).select(
        "driver_id", "driver_name", *order, "race_name", "finish_position"
    )
    return (
        ordered.sliding(
            finished, ["driver_id"], order, races - 1,
            {"form": F.avg("finish_position"), "races_in_window": F.count("*")}, chunk_rows,
        )
        .withColumn("form", F.round("form", 2))
        .orderBy(ascending("driver_name"), *[ascending(c) for c in order])
    )


def teammates(
    star: Star,
    season: int | None = None,
    min_races: int = MIN_SHARED_RACES,
) -> DataFrame:
    """Team-mates compared over the races both entered for the team."""
    drivers = star.driver.select("driver_id", F.col("full_name").alias("name"))
    teams = star.constructor.select("constructor_id", F.col("constructor_name").alias("team"))
    races = views.season_races(star, season).select("race_id")
    rows = (
        views.of_season(star, star.result, season)
        .select("race_id", "constructor_id", "driver_id", "position_order")
        .join(races, "race_id", "left_semi")
        .join(teams, "constructor_id")
        .join(drivers, "driver_id")
        .select(
            "race_id", "constructor_id", "team", F.col("driver_id").alias("member"), "name",
            F.col("position_order").alias("position"),
        )
    )
    return (
        head_to_head(rows, ["race_id", "constructor_id"], min_races)
        .select(
            F.col("team").alias("constructor_name"),
            F.col("name_a").alias("driver_a"),
            F.col("name_b").alias("driver_b"),
            F.col("shared").alias("races_together"),
            "a_ahead",
            "b_ahead",
            percentage(F.col("a_ahead"), F.col("shared")).alias("a_win_pct"),
        )
        .orderBy(
            descending("a_win_pct"), ascending("constructor_name"), ascending("driver_a"),
            ascending("driver_b"),
        )
    )


def pit_spread(performance: DataFrame) -> DataFrame:
    """Median and tail of stop times, with the speed quartile over the whole field."""
    order = ["median_stop_seconds", "season_year", "constructor_id"]
    spread = (F.col("p90_stop_seconds") - F.col("median_stop_seconds")).alias(
        "consistency_spread"
    )
    return (
        ordered.tiles(performance, 4, order, "speed_quartile")
        .select(
            "season_year", "constructor_name", "stop_count", "median_stop_seconds",
            "p90_stop_seconds", spread, "season_rank", "seconds_vs_field_median",
            "speed_quartile",
        )
        .orderBy(
            ascending("season_year"), ascending("season_rank"), ascending("constructor_name")
        )
    )


def points_pivot(reliability: DataFrame, seasons: Sequence[int]) -> DataFrame:
    """Team points, one column per named season, best of the last season first."""
    return (
        reliability.filter(F.col("season_year").between(min(seasons), max(seasons)))
        .groupBy("constructor_name")
        .pivot("season_year", list(seasons))
        .agg(F.sum("season_points"))
        .orderBy(F.col(f"`{seasons[-1]}`").desc_nulls_last(), ascending("constructor_name"))
    )


def rank_divergence(reliability: DataFrame) -> DataFrame:
    """Reliability rank against points rank, per season.

    The frame has a row for each season and team, so a season's teams are what a window holds.
    """
    ranked = reliability
    for value, out in (("finish_rate_pct", "reliability_rank"), ("season_points", "points_rank")):
        ranked = ordered.rank_within(ranked, ["season_year"], value, out)
    return ranked.select(
        "season_year", "constructor_name", "entries", "finish_rate_pct", "mechanical_dnfs",
        "incident_dnfs", "season_points", "reliability_rank", "points_rank",
        (F.col("reliability_rank") - F.col("points_rank")).alias("rank_divergence"),
    ).orderBy(
        ascending("season_year"), descending("rank_divergence"), ascending("constructor_name")
    )


def droughts(
    results: DataFrame,
    min_races: int = MIN_DROUGHT,
    size: int = LONGEST_DROUGHTS,
    seasons: tuple[int, int] | None = None,
    order: Sequence[str] = ("race_date", "result_id"),
) -> DataFrame:
    """Longest runs without a win after a first one.

    The running number of wins names the island a race belongs to; islands are then a
    plain grouping, so the data is read once and never joined to itself.
    """
    if seasons is not None:
        results = results.filter(F.col("season_year").between(*map(int, seasons)))
    races = results.select("driver_id", "driver_name", *order, "is_win")
    counted = ordered.running_sums(races, ["driver_id"], order, {"wins_so_far": "is_win"})
    start, end = F.col("drought_start"), F.col("drought_end")
    return (
        counted.filter((F.col("wins_so_far") > 0) & (F.col("is_win") == 0))
        .groupBy("driver_id", "driver_name", "wins_so_far")
        .agg(
            F.count("*").alias("races_in_drought"),
            F.min(order[0]).alias("drought_start"),
            F.max(order[0]).alias("drought_end"),
        )
        .filter(F.col("races_in_drought") >= min_races)
        .orderBy(
            descending("races_in_drought"), ascending("drought_start"), ascending("driver_id")
        )
        .limit(size)
        .select(
            "driver_name", "races_in_drought", "drought_start", "drought_end",
            F.date_diff(end, start).cast("bigint").alias("days_without_a_win"),
        )
    )
