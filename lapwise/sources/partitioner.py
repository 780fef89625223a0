"""Split season-less fact files by season, through the race that each row names."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.session import release
from lapwise.sources.entities import ENTITIES
from lapwise.sources.inventory import staged_files

# Files written at one time; their jobs overlap.
AT_ONCE = 4


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, every value as the text it is written as.

    No token is read as NULL and no field is trimmed: ``\\N``, ``01`` and padding survive,
    and an empty field stays an empty string.
    """
    text = spark.read.csv(
        path, header=True, inferSchema=False, quote='"', escape='"', nullValue="\u0000",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return text.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in text.columns])


class SourceError(ValueError):
    """A source file is missing or lacks the columns that its season is found by."""


def prepare(
    spark: SparkSession,
    source: str,
    target: str,
    min_season: int | None = None,
    max_season: int | None = None,
    null_token: str = "",
) -> int:
    """Lay out a folder of seven CSV files as staged files; returns how many were written.

    Facts are split by the season of the race they name, within the inclusive window; the
    other files are copied whole.  All values stay the text they are written as.
    """
    tables = {name: _opened(spark, f"{source}/{name}.csv") for name in ENTITIES}
    races = _requiring(tables["races"], "races", "raceId", "year")
    facts = {n: _requiring(tables[n], n, "raceId") for n, entity in ENTITIES.items() if entity.by_season}

    def write(name: str) -> None:
        if name in facts:
            split = with_season(facts[name], races, min_season=min_season, max_season=max_season)
            write_seasons(split.rows, f"{target}/{name}", null_token=null_token)
        else:
            write_whole(tables[name], f"{target}/{name}", "gzip", null_token)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(write, ENTITIES))
    return staged_files(spark, target, r".*[.]csv([.]gz)?$").count()


def _opened(spark: SparkSession, path: str) -> DataFrame:
    try:
        return read_source(spark, path)
    except AnalysisException as error:
        raise SourceError(f"cannot read {path}: {error.getCondition()}") from error


def _requiring(df: DataFrame, name: str, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SourceError(f"{name}.csv lacks {', '.join(missing)}")
    return df


@dataclass(frozen=True)
class Partitioned:
    rows: DataFrame
    unmatched: DataFrame


def with_season(
    facts: DataFrame,
    races: DataFrame,
    race_key: str = "raceId",
    season_key: str = "year",
    min_season: int | None = None,
    max_season: int | None = None,
) -> Partitioned:
    """Attach ``season`` and keep the inclusive window; rows of unknown races come apart.

    A frame with its own season column keeps it.
    """
    if season_key in facts.columns:
        tagged = facts.withColumn("season", F.col(season_key).try_cast("int"))
    else:
        lookup = races.groupBy(race_key).agg(
            F.min(F.col(season_key).try_cast("int")).alias("season")
        )
        tagged = facts.join(lookup, race_key, "left").select(*facts.columns, "season")
    season = F.col("season")
    rows = tagged.filter(season.isNotNull())
    if min_season is not None:
        rows = rows.filter(season >= int(min_season))
    if max_season is not None:
        rows = rows.filter(season <= int(max_season))
    return Partitioned(rows, tagged.filter(season.isNull()).drop("season"))


def write_seasons(
    rows: DataFrame, path: str, compression: str = "gzip", null_token: str = ""
) -> None:
    """One directory per season with the season out of the payload.

    The rebalance hint gathers a small season into one file and lets AQE cut a large
    one into several, so no season is written by a single task.
    """
    (
        rows.hint("rebalance", "season")
        .write.mode("overwrite")
        .partitionBy("season")
        .options(**_csv(compression, null_token))
        .csv(path)
    )
    release(rows.sparkSession)


def write_sorted(
    rows: DataFrame, path: str, order: Column, compression: str = "none", null_token: str = ""
) -> None:
    """One directory per season; rows stay in their partitions, whose files are in ``order``."""
    (
        rows.withColumn("__order", order)
        .sortWithinPartitions("season", "__order")
        .drop("__order")
        .write.mode("overwrite")
        .partitionBy("season")
        .options(**_csv(compression, null_token))
        .csv(path)
    )


def write_whole(
    rows: DataFrame, path: str, compression: str = "none", null_token: str = ""
) -> None:
    """A dimension copied through unpartitioned."""
    rows.write.mode("overwrite").options(**_csv(compression, null_token)).csv(path)


def _csv(compression: str, null_token: str) -> dict[str, str]:
    return {
        "header": "true", "quote": '"', "escape": '"', "emptyValue": "",
        "nullValue": null_token, "compression": compression,
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
