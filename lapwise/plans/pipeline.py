"""Landing, typed and star tables of one archive, and the steps between them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.operators import quality
from lapwise.operators.incremental import require_row_local
from lapwise.operators.tables import BUCKET, BucketTable, exists, table_at
from lapwise.operators.upsert import UpsertReport, only_buckets, upsert
from lapwise.plans import conform
from lapwise.plans.metrics import BucketMetrics, suites
from lapwise.plans.star import PROJECTIONS, Star
from lapwise.session import COMPRESSION, FILE_ROWS, passing, release, stored
from lapwise.sources import audit as audit_rows
from lapwise.sources import lines as line_source
from lapwise.sources.entities import ENTITIES, LINEAGE, Entity
from lapwise.sources.inventory import FILE_KEY, pending, staged_files

LEDGER = "target_table string, file_name string, file_size bigint, file_modified timestamp"
REJECTS = (
    "target_table string, error_message string, file_name string, line_number bigint, "
    "character_pos bigint, rejected_record string, recorded_at timestamp"
)
AUDIT = (
    "target_table string, file_name string, last_load_time timestamp, row_count bigint, "
    "row_parsed bigint, error_count bigint, first_error_message string, load_status string, "
    "recorded_at timestamp"
)


BATCH = "batch"

# File names that the driver holds at once; a larger arrival lands as several batches.
FILES_AT_ONCE = 10_000

Outcome = TypeVar("Outcome")


# Lists of rewritten buckets: one for the star's refresh, one for the metrics.
FOLLOWERS = ("stale", "unmeasured")


class NothingStaged(RuntimeError):
    """A first load found no file at all: usually a wrong prefix or pattern."""


@dataclass
class Archive:
    """Folders of one archive below ``root``, which all executors must share."""

    spark: SparkSession
    root: str
    bucket_width: dict[str, int] = field(
        default_factory=lambda: {"results": 1_000_000, "pit_stops": 100}
    )
    hash_buckets: int = 4
    _schemas: dict[str, T.StructType] = field(default_factory=dict, repr=False)

    # -- batches --------------------------------------------------------------

    def _marks(self, kind: str, entity: Entity) -> DataFrame:
        """The batches an entity has gone through a step with; repeated steps leave repeated rows."""
        return table_at(self.spark, f"{self.root}/{kind}/{entity.name}", f"{BATCH} string")

    def _mark(self, kind: str, entity: Entity, batches: DataFrame) -> None:
        """Add batches to a step's table; this one write is what makes them count."""
        batches.coalesce(1).write.mode("append").parquet(f"{self.root}/{kind}/{entity.name}")

    def _named(self, names: Iterable[str]) -> DataFrame:
        return self.spark.createDataFrame([(n,) for n in names], f"{BATCH} string")

    def landed_batches(self, entity: Entity) -> DataFrame:
        """Batches that landed completely; anything else on disk is ignored."""
        return self._marks("landed", entity)

    def waiting(self, entity: Entity) -> DataFrame:
        """Landed batches not yet in the typed table."""
        return self.landed_batches(entity).join(self._marks("conformed", entity), BATCH, "left_anti")

    def batches(self, entity: Entity) -> list[str]:
        """Names of the landed batches, for people; no step lists them."""
        return sorted(r[BATCH] for r in self.landed_batches(entity).distinct().collect())

    def unconformed(self, entity: Entity) -> list[str]:
        return sorted(r[BATCH] for r in self.waiting(entity).distinct().collect())

    def fresh_name(self, entity: Entity, batch: str) -> str:
        """``batch``, numbered if batches of that name have landed."""
        number = F.regexp_extract(BATCH, r"[+]([0-9]+)$", 1)
        last = self.landed_batches(entity).select(
            F.when(F.col(BATCH) == batch, 1)
            .when(F.col(BATCH) == F.concat(F.lit(f"{batch}+"), number), number.try_cast("int"))
            .alias("n")
        ).agg(F.max("n")).first()[0]
        return batch if last is None else f"{batch}+{last + 1}"

    # -- tables ---------------------------------------------------------------

    def _batch_path(self, kind: str, entity: Entity, batch: str) -> str:
        return f"{self.root}/{kind}/{entity.name}/{BATCH}={batch}"

    def _rows(
        self, kind: str, entity: Entity, schema: T.StructType | str,
        batches: DataFrame | None = None,
    ) -> DataFrame:
        """Rows of an entity's table by batch: of landed batches, or of the given ones.

        The table is read by its one path; batches are a partition column and a semi-join.
        """
        if isinstance(schema, str):
            schema = T.StructType.fromDDL(schema)
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
        rows = table_at(self.spark, f"{self.root}/{kind}/{entity.name}", whole)
        kept = self.landed_batches(entity) if batches is None else batches
        return rows.join(kept.filter(F.col(BATCH) != ""), BATCH, "left_semi").select(*schema.names)

    def _every(self, kind: str, schema: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [self._rows(kind, e, schema) for e in ENTITIES.values()])

    def landing(self, entity: Entity, batches: list[str] | DataFrame | None = None) -> DataFrame:
        """Landed rows, of all batches or the given ones."""
        if isinstance(batches, list):
            batches = self.landed_batches(entity).filter(F.col(BATCH).isin(batches))
        return self._rows("landing", entity, landing_schema(entity), batches)

    def rejects(self) -> DataFrame:
        return self._every("rejects", REJECTS)

    def audit(self) -> DataFrame:
        """Rows written with each load and those added by `record_history`."""
        return self._every("audit", AUDIT).unionByName(
            table_at(self.spark, f"{self.root}/recorded", AUDIT)
        )

    def metrics(self) -> DataFrame:
        """Every stored measurement."""
        path = f"{self.root}/metrics"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], quality.RESULT)
        return self.spark.read.schema(quality.RESULT).option("recursiveFileLookup", "true").parquet(path)

    def store_metrics(self, measured: DataFrame, name: str = "all") -> None:
        """Add measurements to the history; writers at one time need folders of their own."""
        measured.write.mode("append").parquet(f"{self.root}/metrics/{name}")

    def bucket_metrics(self, entity: Entity) -> BucketMetrics:
        """What each bucket of a typed table contributes to its metrics."""
        return BucketMetrics(self.spark, f"{self.root}/measured/{entity.name}", entity.name)

    def record_history(
        self, history: DataFrame, now: dt.datetime, lookback_hours: int | None = None
    ) -> int:
        """Add the load history of the last hours that the audit lacks; returns how many rows."""
        at = F.lit(now).cast("timestamp")
        fresh = audit_rows.unrecorded(history, self.audit(), at, lookback_hours)
        seen = Observation()
        fresh.withColumn("recorded_at", at).observe(seen, F.count("*").alias("n")).select(
            *T.StructType.fromDDL(AUDIT).fieldNames()
        ).write.mode("append").parquet(f"{self.root}/recorded")
        return seen.get["n"]

    def ledger(self, entity: Entity) -> DataFrame:
        """Files that have landed, by batch load or by stream."""
        return self._rows("ledger", entity, LEDGER)

    def typed_table(self, entity: Entity) -> BucketTable:
        if entity.name not in self._schemas:
            empty = self.spark.createDataFrame([], landing_schema(entity))
            self._schemas[entity.name] = conform.table_schema(empty, entity)
        path = f"{self.root}/typed/{entity.name}"
        return BucketTable(self.spark, path, self._schemas[entity.name])

    def star_table(self, entity: Entity) -> BucketTable:
        table, project = PROJECTIONS[entity.name]
        key = f"star/{table}"
        if key not in self._schemas:
            empty = self.spark.createDataFrame([], self.typed_table(entity).schema)
            fields = [T.StructField(f.name, f.dataType) for f in project(empty).schema]
            self._schemas[key] = T.StructType(fields)
        return BucketTable(self.spark, f"{self.root}/star/{table}", self._schemas[key])

    def typed(self, entity: Entity) -> DataFrame:
        return self.typed_table(entity).read().drop(BUCKET)

    def star(self) -> Star:
        def source(entity: Entity) -> Callable[[], DataFrame]:
            return lambda: self.star_table(entity).read().drop(BUCKET)

        return Star({t: source(ENTITIES[name]) for name, (t, _) in PROJECTIONS.items()})

    # -- steps ----------------------------------------------------------------

    def for_each(
        self,
        step: Callable[[Entity], Outcome],
        names: Iterable[str] = tuple(ENTITIES),
        at_once: int = 4,
    ) -> dict[str, Outcome]:
        """Run a step for several entities; they are independent, so their jobs overlap."""
        names = tuple(names)
        with ThreadPoolExecutor(at_once) as pool:
            return dict(zip(names, pool.map(lambda n: step(ENTITIES[n]), names)))

    def bring_up(
        self, staged_root: str, batch: str, now: dt.datetime, measuring: bool = True
    ) -> dict[str, UpsertReport]:
        """Load what is new, upsert it, refresh the star and measure what changed.

        A run that died at any point is completed by the next one: batches landed but not
        upserted are taken along, newest load first within a key.
        """

        def step(entity: Entity) -> UpsertReport:
            self.load(entity, staged_root, batch, now)
            report = self.catch_up(entity, now)
            if measuring:
                self.measure(now, [entity.name])
            return report

        return self.for_each(step)

    def catch_up(self, entity: Entity, now: dt.datetime) -> UpsertReport:
        """Upsert the waiting batches and refresh the star."""
        waiting = stored(self.waiting(entity).distinct(), "waiting")
        report = UpsertReport(0, 0, 0)
        if not waiting.isEmpty():
            report = self.conform(entity, now, waiting)
        self.refresh(entity)
        return report

    def load(
        self,
        entity: Entity,
        staged_root: str,
        batch: str,
        loaded_at: dt.datetime,
        force: bool = False,
    ) -> int:
        """Land the files of the entity's prefix that the ledger does not hold.

        Returns how many files were taken.  A batch name that has landed before gets a number,
        so no load replaces another.
        """
        staged = staged_files(self.spark, f"{staged_root}/{entity.name}", entity.file_pattern)
        taken = self.take(entity, staged, batch, loaded_at, force)
        if not taken and not force and self.ledger(entity).isEmpty():
            raise NothingStaged(f"no file for {entity.name} under {staged_root}")
        return taken

    def take(
        self,
        entity: Entity,
        files: DataFrame,
        batch: str,
        loaded_at: dt.datetime,
        force: bool = False,
        replay: bool = False,
    ) -> int:
        """Land those of the ``files`` that the ledger does not hold; returns how many.

        Batch loads and streams both come through here.  A reader needs its paths by name, so
        the driver holds the names of one batch: files are dealt by a hash into as many
        batches as `FILES_AT_ONCE` asks for.  ``replay`` keeps the name as it is: a batch that
        did not count is written anew.
        """
        fresh = pending(files, self.ledger(entity), force).select(*FILE_KEY).distinct()
        first = fresh.limit(FILES_AT_ONCE + 1).collect()
        if not first:
            return 0
        parts, count = [first], len(first)
        if count > FILES_AT_ONCE:
            fresh = stored(fresh, "files")
            count = fresh.count()
            shares = -(-2 * count // FILES_AT_ONCE)
            own = F.pmod(F.xxhash64("file_name"), F.lit(shares))
            parts = (fresh.filter(own == share).collect() for share in range(shares))
        for share, rows in enumerate(parts):
            if rows:
                name = (f"{batch}.{share}" if share else batch) if replay else self.fresh_name(entity, batch)
                listed = self.spark.createDataFrame([(entity.name, *r) for r in rows], LEDGER)
                lines = line_source.read_lines(self.spark, [r["file_name"] for r in rows])
                self.land(entity, lines, name, loaded_at, listed)
        return count

    def land(
        self,
        entity: Entity,
        lines: DataFrame,
        batch: str,
        loaded_at: dt.datetime,
        files: DataFrame | None = None,
    ) -> None:
        """Write landing, reject, ledger and audit rows of one batch.

        ``files`` (target_table and the file's identity) go to the ledger; those without any
        record get an audit row as well.

        Each goes to the batch's own folder, overwritten on a replay, and counts only once
        the batch is marked as landed, so a failure in between leaves no half batch and no
        row twice.
        """
        with passing(self.spark):
            judged = line_source.judged(lines)
            landing_path = self._batch_path("landing", entity, batch)
            reject_path = self._batch_path("rejects", entity, batch)
            seen = Observation()
            bad = F.count_if(F.col("error").isNotNull()).alias("rejected")
            good = judged.observe(seen, bad).filter(F.col("error").isNull())
            line_source.landed(good, entity, loaded_at).write.mode("overwrite").options(
                compression=COMPRESSION, maxRecordsPerFile=FILE_ROWS
            ).parquet(landing_path)
            loaded = self.spark.read.schema(landing_schema(entity)).parquet(landing_path)
            rejected = self.spark.createDataFrame([], REJECTS)
            # A clean batch, the usual case, needs no second pass.
            if seen.get["rejected"]:
                line_source.rejects(judged, entity, loaded_at).write.mode("overwrite").parquet(
                    reject_path
                )
                rejected = self.spark.read.schema(REJECTS).parquet(reject_path)
            label = F.lit(entity.name).alias("target_table")
            history = audit_rows.load_history(
                loaded.select(
                    label,
                    F.col("dw_file_name").alias("file_name"),
                    F.col("dw_loaded_at").alias("last_load_time"),
                ),
                rejected.select(
                    label, "file_name", F.col("recorded_at").alias("last_load_time"),
                    "line_number", "error_message",
                ),
            )
            if files is not None:
                files.write.mode("overwrite").parquet(self._batch_path("ledger", entity, batch))
                named = files.select("target_table", "file_name")
                history = audit_rows.with_empty_files(history, named, F.lit(loaded_at).cast("timestamp"))
            history.withColumn("recorded_at", F.lit(loaded_at).cast("timestamp")).write.mode(
                "overwrite"
            ).parquet(self._batch_path("audit", entity, batch))
        release(self.spark)
        self._mark("landed", entity, self._named([batch]))

    def conform(
        self,
        entity: Entity,
        now: dt.datetime,
        batches: list[str] | DataFrame | None = None,
        narrow: bool = False,
    ) -> UpsertReport:
        """Upsert landed rows into the typed table, from all batches or only the given ones."""
        width = self.bucket_width.get(entity.name, self.hash_buckets)
        if isinstance(batches, list):
            batches = self._named(batches)
        taken = self.landed_batches(entity).distinct()
        if batches is not None:
            taken = taken.join(batches, BATCH, "left_semi")
        taken = stored(taken, "taken")
        rows = conform.arrivals(self.landing(entity, taken), entity, width)
        report = upsert(
            self.typed_table(entity), conform.newest_landed(rows, entity), entity.key,
            F.lit(now).cast("timestamp"),
            announce=lambda buckets: self._announce(entity, buckets),
            finish=lambda newest: conform.finished(newest, entity, narrow), buckets=rows,
        )
        self._mark("conformed", entity, taken)
        return report

    def _announce(self, entity: Entity, buckets: DataFrame) -> None:
        """List the buckets an upsert is about to rewrite, for those that follow the table."""
        for kind in FOLLOWERS:
            buckets.write.mode("append").parquet(f"{self.root}/{kind}/{entity.name}")

    def _listed(self, kind: str, entity: Entity) -> DataFrame:
        """The buckets listed for a follower."""
        path = f"{self.root}/{kind}/{entity.name}"
        return stored(table_at(self.spark, path, f"{BUCKET} bigint").distinct(), kind)

    def _done(self, kind: str, entity: Entity) -> None:
        empty = self.spark.createDataFrame([], f"{BUCKET} bigint")
        empty.write.mode("overwrite").parquet(f"{self.root}/{kind}/{entity.name}")

    def refresh(self, entity: Entity) -> int:
        """Bring the star table up to the typed table; returns how many buckets it projected.

        An upsert lists the buckets it is about to rewrite, and the list is emptied here
        when they are projected, so a refresh that failed is caught up by the next one.
        The projection is row-local (checked), so a bucket of the star depends on the same
        bucket of the typed table and nothing else.
        """
        buckets = self._listed("stale", entity)
        count = buckets.count()
        if count:
            _, project = PROJECTIONS[entity.name]
            rows = require_row_local(project(self.typed_table(entity).read(), BUCKET))
            self.star_table(entity).replace(only_buckets(rows, buckets), buckets, gathered=True)
            self._done("stale", entity)
        return count

    def measure(self, now: dt.datetime, names: Iterable[str] | None = None) -> list[str]:
        """Measure the tables that changed and add the numbers to the history.

        Only buckets that were rewritten are read; the other buckets' shares of the counts
        are kept from before.  Returns the names of the measured tables.
        """
        at = F.lit(now).cast("timestamp")
        measured = []
        for name in suites(at) if names is None else [n for n in names if n in suites(at)]:
            entity = ENTITIES[name]
            buckets = self._listed("unmeasured", entity)
            if buckets.isEmpty():
                continue
            shares = self.bucket_metrics(entity)
            shares.update(only_buckets(self.typed_table(entity).read(), buckets), buckets, at)
            self.store_metrics(shares.totals(at), name)
            self._done("unmeasured", entity)
            measured.append(name)
        return measured


def landing_schema(entity: Entity) -> T.StructType:
    lineage = dict(
        zip(LINEAGE, (T.StringType(), T.LongType(), T.TimestampType(), T.TimestampType()))
    )
    return T.StructType(
        [*entity.landing_schema.fields, *[T.StructField(n, t) for n, t in lineage.items()]]
    )
