"""Five dimensions and two facts, each a row-local projection of one typed table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import day_name, flag

# Plausible pit-stop durations, in milliseconds.
MIN_STOP_MS = 1000
MAX_STOP_MS = 300000


@dataclass
class Star:
    """Dimension and fact tables by name, each built when first asked for."""

    sources: dict[str, Callable[[], DataFrame]]

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_") or table not in self.sources:
            raise AttributeError(table)
        built = self.sources[table]()
        setattr(self, table, built)
        return built


def driver_dim(typed: DataFrame, *keep: str) -> DataFrame:
    return typed.select(
        "driver_id", "driver_ref", "driver_code", "permanent_number", "forename", "surname",
        "full_name", "date_of_birth", "nationality", *keep,
    )


def constructor_dim(typed: DataFrame, *keep: str) -> DataFrame:
    return typed.select(
        "constructor_id", "constructor_ref", "constructor_name", "nationality", *keep
    )


def circuit_dim(typed: DataFrame, *keep: str) -> DataFrame:
    return typed.select(
        "circuit_id", "circuit_ref", "circuit_name", "location", "country", "latitude",
        "longitude", "altitude_m", *keep,
    )


def race_dim(typed: DataFrame, *keep: str) -> DataFrame:
    return typed.select(
        "race_id", "season_year", "round_number", "circuit_id", "race_name", "race_date",
        "race_start_utc",
        F.month("race_date").alias("race_month"),
        day_name("race_date").alias("race_day_name"),
        *keep,
    )


def retirement_category(classified: Column, description: Column) -> Column:
    """Five outcome buckets; anything unrecognised, NULL text included, is mechanical."""
    mentions = description.ilike
    return (
        F.when(classified, "Classified")
        .when(mentions("%Disqualified%"), "Disqualified")
        .when(
            mentions("%Accident%") | mentions("%Collision%") | mentions("%Spun off%"), "Incident"
        )
        .when(mentions("%Withdrew%") | mentions("%Did not%"), "Did not start")
        .otherwise("Mechanical")
    )


def status_dim(typed: DataFrame, *keep: str) -> DataFrame:
    return typed.select(
        "status_id", "status_description", "is_classified_finish",
        retirement_category(
            F.col("is_classified_finish"), F.col("status_description")
        ).alias("retirement_category"),
        *keep,
    )


def positions_gained(grid: Column, finish: Column) -> Column:
    """NULL, not 0, where the measure does not apply: pit-lane start or no finish."""
    return F.when((grid != 0) & finish.isNotNull(), grid - finish)


def result_fact(typed: DataFrame, *keep: str) -> DataFrame:
    grid, finish = F.col("grid_position"), F.col("finish_position")
    return typed.select(
        "result_id", "race_id", "driver_id", "constructor_id", "status_id", "grid_position",
        "finish_position", "position_order", "points", "laps_completed", "race_duration_ms",
        "fastest_lap_ms", "fastest_lap_speed_kph",
        F.when(grid == 0, True).otherwise(False).alias("is_pit_lane_start"),
        positions_gained(grid, finish).alias("positions_gained"),
        flag(finish == 1).alias("is_win"),
        flag(finish <= 3).alias("is_podium"),
        *keep,
    )


def pit_stop_fact(typed: DataFrame, *keep: str) -> DataFrame:
    """Timing artefacts stay in the typed table and are left out here."""
    return typed.filter(F.col("duration_ms").between(MIN_STOP_MS, MAX_STOP_MS)).select(
        "pit_stop_key", "race_id", "driver_id", "stop_number", "lap_number", "duration_ms",
        F.round(F.col("duration_ms").cast("decimal(18,0)") / 1000, 3)
        .cast("decimal(18,3)")
        .alias("duration_seconds"),
        *keep,
    )


# Typed table -> star table and the projection between them.  A projection also passes
# the named ``keep`` columns through.
PROJECTIONS = {
    "drivers": ("driver", driver_dim),
    "constructors": ("constructor", constructor_dim),
    "circuits": ("circuit", circuit_dim),
    "races": ("race", race_dim),
    "status": ("status", status_dim),
    "results": ("result", result_fact),
    "pit_stops": ("pit_stop", pit_stop_fact),
}


def build_star(typed: Callable[[str], DataFrame]) -> Star:
    """Star over typed tables fetched by entity name."""

    def source(name: str, project: Callable[..., DataFrame]) -> Callable[[], DataFrame]:
        return lambda: project(typed(name))

    return Star({table: source(name, project) for name, (table, project) in PROJECTIONS.items()})
