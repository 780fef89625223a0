"""Layouts of the seven entities: landing columns, typed columns, keys.

Everything that differs between entities is data in this module; loading, typing
and upserting are written once and read it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise import functions as fx

LINEAGE = ("dw_file_name", "dw_file_row_number", "dw_file_last_modified", "dw_loaded_at")
HOUSEKEEPING = ("row_hash", "dw_source_file", "dw_inserted_at", "dw_updated_at")

# File-name patterns.  A season's files are named after it, or lie in its
# folder under the names Spark gives its own output.
SEASON_FILE = r".*({name}_[0-9]{{4}}|season=[0-9]{{4}}/part-[^/]*)[.]csv([.]gz)?$"
ANY_FILE = r".*[.]csv([.]gz)?$"

CASTS = {
    "text": F.col,
    "number": fx.try_number,
    "int": fx.try_int,
    "double": fx.try_double,
    "decimal": fx.try_decimal,
    "date": fx.try_date,
    "time": fx.try_time,
    "duration": fx.duration_to_ms,
}


@dataclass(frozen=True)
class Entity:
    """One source file and the typed table made from it.

    ``typed`` lists (output column, cast, landing column); ``derived`` names columns
    computed from landing columns by the functions in ``DERIVATIONS``.
    """

    name: str
    landing: tuple[str, ...]
    key: str
    typed: tuple[tuple[str, str, str], ...]
    derived: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    unhashed: tuple[str, ...] = ()
    narrow_unhashed: tuple[str, ...] = ()
    by_season: bool = False
    bucket_on: str | None = None

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.landing])

    @property
    def file_pattern(self) -> str:
        return SEASON_FILE.format(name=self.name) if self.by_season else ANY_FILE

    @property
    def required_columns(self) -> tuple[str, ...]:
        """Columns whose text must parse for a row to be kept."""
        return self.required or (self.key,)

    def business_columns(self) -> list[str]:
        return [c for c, _, _ in self.typed] + list(self.derived)

    def hash_columns(self, narrow: bool = False) -> list[str]:
        """Columns under change detection: all business columns but the key.

        ``narrow`` also leaves out the entity's ``narrow_unhashed`` columns.
        """
        skipped = {self.key, *self.required_columns, *self.unhashed}
        if narrow:
            skipped |= set(self.narrow_unhashed)
        return [c for c in self.business_columns() if c not in skipped]

    def sources(self) -> list[str]:
        """Landing columns any business column is made of."""
        used = {source for _, _, source in self.typed}
        for name in self.derived:
            used.update(DERIVATIONS[name][1])
        return [c for c in self.landing if c in used]

    def expression(self, name: str) -> Column:
        """A business column out of landing columns."""
        if name in self.derived:
            return DERIVATIONS[name][0]()
        cast, source = next((c, s) for out, c, s in self.typed if out == name)
        return CASTS[cast](source)

    def identity(self) -> Column:
        """What tells rows of one key: the key, or the text it is the digest of."""
        return IDENTITIES.get(self.key, lambda: self.expression(self.key))()

    def projection(self) -> list[Column]:
        return [self.expression(name).alias(name) for name in self.business_columns()]


def _full_name() -> Column:
    return F.trim(F.concat(F.col("forename"), F.lit(" "), F.col("surname")))


def _classified() -> Column:
    return (fx.try_number("statusId") == 1) | F.col("status").ilike("+%Lap%")


def _pit_stop() -> Column:
    return F.concat_ws("||", "raceId", "driverId", "stop")


def _pit_stop_key() -> Column:
    return F.sha2(_pit_stop(), 256)


def _pit_duration() -> Column:
    return F.coalesce(fx.try_number("milliseconds"), fx.duration_to_ms("duration"))


# Derived column -> its expression and the landing columns that go into it.
DERIVATIONS = {
    "full_name": (_full_name, ("forename", "surname")),
    "is_classified_finish": (_classified, ("statusId", "status")),
    "pit_stop_key": (_pit_stop_key, ("raceId", "driverId", "stop")),
    "duration_ms": (_pit_duration, ("milliseconds", "duration")),
}

# Key column that is a digest -> the text that it is taken of, which is shorter.
IDENTITIES = {"pit_stop_key": _pit_stop}

CIRCUITS = Entity(
    name="circuits",
    landing=(
        "circuitId", "circuitRef", "name", "location", "country", "lat", "lng", "alt", "url",
    ),
    key="circuit_id",
    typed=(
        ("circuit_id", "number", "circuitId"),
        ("circuit_ref", "text", "circuitRef"),
        ("circuit_name", "text", "name"),
        ("location", "text", "location"),
        ("country", "text", "country"),
        ("latitude", "double", "lat"),
        ("longitude", "double", "lng"),
        ("altitude_m", "int", "alt"),
    ),
)

CONSTRUCTORS = Entity(
    name="constructors",
    landing=("constructorId", "constructorRef", "name", "nationality", "url"),
    key="constructor_id",
    typed=(
        ("constructor_id", "number", "constructorId"),
        ("constructor_ref", "text", "constructorRef"),
        ("constructor_name", "text", "name"),
        ("nationality", "text", "nationality"),
    ),
)

DRIVERS = Entity(
    name="drivers",
    landing=(
        "driverId", "driverRef", "number", "code", "forename", "surname", "dob",
        "nationality", "url",
    ),
    key="driver_id",
    typed=(
        ("driver_id", "number", "driverId"),
        ("driver_ref", "text", "driverRef"),
        ("permanent_number", "int", "number"),
        ("driver_code", "text", "code"),
        ("forename", "text", "forename"),
        ("surname", "text", "surname"),
        ("date_of_birth", "date", "dob"),
        ("nationality", "text", "nationality"),
    ),
    derived=("full_name",),
    unhashed=("full_name",),
)

STATUS = Entity(
    name="status",
    landing=("statusId", "status"),
    key="status_id",
    typed=(
        ("status_id", "number", "statusId"),
        ("status_description", "text", "status"),
    ),
    derived=("is_classified_finish",),
)

RACES = Entity(
    name="races",
    landing=("raceId", "year", "round", "circuitId", "name", "date", "time", "url"),
    key="race_id",
    typed=(
        ("race_id", "number", "raceId"),
        ("season_year", "int", "year"),
        ("round_number", "int", "round"),
        ("circuit_id", "number", "circuitId"),
        ("race_name", "text", "name"),
        ("race_date", "date", "date"),
        ("race_start_utc", "time", "time"),
    ),
    by_season=True,
)

RESULTS = Entity(
    name="results",
    landing=(
        "resultId", "raceId", "driverId", "constructorId", "number", "grid", "position",
        "positionText", "positionOrder", "points", "laps", "time", "milliseconds",
        "fastestLap", "rank", "fastestLapTime", "fastestLapSpeed", "statusId",
    ),
    key="result_id",
    typed=(
        ("result_id", "number", "resultId"),
        ("race_id", "number", "raceId"),
        ("driver_id", "number", "driverId"),
        ("constructor_id", "number", "constructorId"),
        ("status_id", "number", "statusId"),
        ("car_number", "int", "number"),
        ("grid_position", "int", "grid"),
        ("finish_position", "int", "position"),
        ("position_order", "int", "positionOrder"),
        ("points", "decimal", "points"),
        ("laps_completed", "int", "laps"),
        ("race_duration_ms", "number", "milliseconds"),
        ("fastest_lap_number", "int", "fastestLap"),
        ("fastest_lap_rank", "int", "rank"),
        ("fastest_lap_ms", "duration", "fastestLapTime"),
        ("fastest_lap_speed_kph", "double", "fastestLapSpeed"),
    ),
    narrow_unhashed=(
        "car_number", "fastest_lap_number", "fastest_lap_rank", "fastest_lap_speed_kph",
    ),
    by_season=True,
    bucket_on="result_id",
)

PIT_STOPS = Entity(
    name="pit_stops",
    landing=("raceId", "driverId", "stop", "lap", "time", "duration", "milliseconds"),
    key="pit_stop_key",
    typed=(
        ("race_id", "number", "raceId"),
        ("driver_id", "number", "driverId"),
        ("stop_number", "int", "stop"),
        ("lap_number", "int", "lap"),
        ("stop_time_local", "time", "time"),
    ),
    derived=("pit_stop_key", "duration_ms"),
    required=("race_id", "driver_id", "stop_number"),
    by_season=True,
    bucket_on="race_id",
)

ENTITIES = {
    e.name: e for e in (CIRCUITS, CONSTRUCTORS, DRIVERS, STATUS, RACES, RESULTS, PIT_STOPS)
}
