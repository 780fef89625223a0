"""Checks run after a load: counts, rejects, orphans, metrics, masked sample."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import ascending
from lapwise.operators import masking, quality
from lapwise.operators.upsert import UpsertReport
from lapwise.plans import views
from lapwise.plans.metrics import suites
from lapwise.plans.pipeline import Archive
from lapwise.plans.star import Star
from lapwise.sources import audit
from lapwise.sources.entities import ENTITIES

# Child table, foreign key, parent table; the key has the same name on both sides.
RELATIONSHIPS = (
    ("results", "race_id", "races"),
    ("results", "driver_id", "drivers"),
    ("results", "constructor_id", "constructors"),
    ("races", "circuit_id", "circuits"),
    ("pit_stops", "race_id", "races"),
)


def reject_counts(archive: Archive) -> DataFrame:
    return audit.rejects_per_table(archive.rejects())


def audit_tail(archive: Archive, count: int = 50) -> DataFrame:
    return audit.latest(archive.audit(), count)


def landed_counts(archive: Archive) -> DataFrame:
    return audit.table_counts({n: archive.landing(e) for n, e in ENTITIES.items()})


def typed_counts(archive: Archive) -> DataFrame:
    tables = {n: archive.typed(e) for n, e in ENTITIES.items()}
    return audit.table_counts(tables, last_change="dw_updated_at")


def integrity(archive: Archive) -> DataFrame:
    return integrity_of({n: archive.typed(e) for n, e in ENTITIES.items()})


def integrity_of(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphans of the five relationships."""
    return quality.integrity(
        [
            (f"{child}.{key} -> {parent}", tables[child], tables[parent], key, key)
            for child, key, parent in RELATIONSHIPS
        ]
    )


def orphan_results(archive: Archive) -> DataFrame:
    return quality.orphan_count(
        archive.typed(ENTITIES["results"]), archive.typed(ENTITIES["races"]), "race_id"
    ).withColumnRenamed("orphan_count", "orphan_results")


def measure(
    archive: Archive, as_of: Column | None = None, only: Iterable[str] | None = None
) -> DataFrame:
    """Metric rows of all attached tables, or of those an upsert changed."""
    wanted = set(suites()) if only is None else set(only)
    parts = [
        quality.measure_table(name, archive.typed(ENTITIES[name]), metrics, unique, as_of)
        for name, (metrics, unique) in suites(as_of).items()
        if name in wanted
    ]
    return reduce(DataFrame.unionByName, parts, archive.spark.createDataFrame([], quality.RESULT))


def measure_changes(
    archive: Archive, reports: Mapping[str, UpsertReport], as_of: Column | None = None
) -> None:
    """Measure the tables that an upsert changed and add the numbers to the history."""
    changed = [name for name, report in reports.items() if report.changed]
    if changed:
        archive.store_metrics(measure(archive, as_of, changed))


def latest_metrics(archive: Archive) -> DataFrame:
    """The newest stored measurement of every metric, with its verdict."""
    return quality.latest_results(archive.metrics())


def profile(star: Star, roles: Iterable[str], as_of: Column | None = None) -> DataFrame:
    """Driver profile as a caller holding ``roles`` may see it."""
    tagged = masking.tag(views.driver_profile(star, as_of), {"date_of_birth": "PII"})
    return masking.apply_masks(tagged, {"PII": masking.mask_date}, roles)


def profile_sample(star: Star, roles: Iterable[str], count: int = 5) -> DataFrame:
    """A few coded drivers with the birth date the caller may see."""
    return (
        profile(star, roles)
        .filter(F.col("driver_code").isNotNull())
        .orderBy(ascending("driver_id"))
        .limit(count)
        .select("driver_code", "full_name", "date_of_birth")
    )
