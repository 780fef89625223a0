"""Registered queries that go through files: staging, landing, upsert, refresh, streams.

Each call works in a fresh folder below the shared scratch folder and returns a frame
read from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.bindings import sales
from lapwise.bindings.sales import month_id, table
from lapwise.functions import exact_hash, to_serving
from lapwise.operators import quality
from lapwise.operators.tables import BUCKET, BucketTable
from lapwise.operators.upsert import UpsertReport, upsert
from lapwise.plans import analysis, verification, views
from lapwise.plans.pipeline import Archive
from lapwise.session import scratch_path
from lapwise.sources import audit, inventory, partitioner
from lapwise.sources import lines as line_source
from lapwise.sources.entities import ENTITIES, Entity
from lapwise.streaming.ingest import ingest

Query = Callable[[SparkSession, str], DataFrame]

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)
NULL_TOKEN = "\\N"
SUPPLIER_KEYS = 10**12
KEYS_PER_BUCKET = 10**6
SPLIT_SEASON = 1997
SEASON_WINDOW = (1996, 2000)
AT_ONCE = 4


# -- upsert ----------------------------------------------------------------------------

ACCOUNT = T.StructType(
    [
        T.StructField("account_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("row_hash", T.StringType()),
        T.StructField("dw_source_file", T.StringType()),
        T.StructField("dw_inserted_at", T.TimestampType()),
        T.StructField("dw_updated_at", T.TimestampType()),
    ]
)


def _accounts(rows: DataFrame, source: str) -> DataFrame:
    return rows.select(
        "account_id", "name", "segment",
        exact_hash(["name", "segment"]).alias("row_hash"),
        F.lit(source).alias("dw_source_file"),
        F.floor(F.col("account_id") / KEYS_PER_BUCKET).cast("bigint").alias(BUCKET),
    )


def _account_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All customers; then all again, overdrawn ones changed, with the suppliers as new keys."""
    customer = table(spark, folder, "customer")
    key, name = F.col("c_custkey").alias("account_id"), F.col("c_name").alias("name")
    first = customer.select(key, name, F.col("c_mktsegment").alias("segment"))
    overdrawn = F.when(F.col("c_acctbal") < 0, "ARREARS").otherwise(F.col("c_mktsegment"))
    second = customer.select(key, name, overdrawn.alias("segment")).unionByName(
        table(spark, folder, "supplier").select(
            (F.col("s_suppkey") + SUPPLIER_KEYS).alias("account_id"),
            F.col("s_name").alias("name"),
            F.lit("SUPPLIER").alias("segment"),
        )
    )
    return _accounts(first, "first.csv"), _accounts(second, "second.csv")


def _run_upserts(spark: SparkSession, folder: str) -> tuple[BucketTable, list[UpsertReport]]:
    accounts = BucketTable(spark, scratch_path(spark, "accounts"), ACCOUNT)
    first, second = _account_batches(spark, folder)
    runs = ((first, T0), (second, T1), (second, T1 + dt.timedelta(days=1)))
    reports = [
        upsert(accounts, batch, "account_id", F.lit(at).cast("timestamp")) for batch, at in runs
    ]
    return accounts, reports


def upsert_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    accounts, _ = _run_upserts(spark, folder)
    stamps = ("dw_inserted_at", "dw_updated_at")
    return accounts.read().select(
        "account_id", "name", "segment", "dw_source_file",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in stamps],
    )


def upsert_report(spark: SparkSession, folder: str) -> DataFrame:
    """Inserted, updated and unchanged keys of three runs; the third repeats the second."""
    _, reports = _run_upserts(spark, folder)
    rows = [(i + 1, r.inserted, r.updated, r.unchanged) for i, r in enumerate(reports)]
    return spark.createDataFrame(rows, "run int, inserted bigint, updated bigint, unchanged bigint")


# -- the archive out of the sales tables -----------------------------------------------


def source_rows(
    spark: SparkSession, folder: str, name: str, repeated: bool = False
) -> DataFrame:
    """One entity's file content as text, in file column order, without the season.

    ``repeated`` leaves stops of one key their own durations.
    """
    rows = sales.typed_table(spark, folder, name)
    cells: dict[str, Column]
    if name == "circuits":
        cells = {
            "circuitId": F.col("circuit_id"), "circuitRef": F.col("circuit_ref"),
            "name": F.col("circuit_name"), "location": F.col("location"),
            "country": F.col("country"), "lat": F.col("latitude"), "lng": F.col("longitude"),
            "alt": F.col("altitude_m"),
        }
    elif name == "constructors":
        cells = {
            "constructorId": F.col("constructor_id"), "constructorRef": F.col("constructor_ref"),
            "name": F.col("constructor_name"), "nationality": F.col("nationality"),
        }
    elif name == "drivers":
        cells = {
            "driverId": F.col("driver_id"), "driverRef": F.col("driver_ref"),
            "number": F.col("permanent_number"), "code": F.col("driver_code"),
            # Commas, quotes and padding have to survive the trip.
            "forename": F.concat(F.col("forename"), F.lit(', "'), F.col("surname"), F.lit('"')),
            "surname": F.concat(F.lit("#"), F.col("surname")),
            "dob": F.col("date_of_birth"), "nationality": F.col("nationality"),
        }
    elif name == "status":
        cells = {"statusId": F.col("status_id"), "status": F.col("status_description")}
    elif name == "races":
        cells = {
            "raceId": F.col("race_id"), "year": F.col("season_year"),
            "round": F.col("round_number"), "circuitId": F.col("circuit_id"),
            "name": F.col("race_name"), "date": F.col("race_date"),
        }
    elif name == "results":
        cells = {
            "resultId": F.col("result_id"), "raceId": F.col("race_id"),
            "driverId": F.col("driver_id"), "constructorId": F.col("constructor_id"),
            "grid": F.col("grid_position"), "position": F.col("finish_position"),
            "positionOrder": F.col("position_order"), "points": F.col("points"),
            "laps": F.col("laps_completed"), "milliseconds": F.col("race_duration_ms"),
            "statusId": F.col("status_id"),
            "number": F.col("driver_id") % 100,
            "positionText": F.coalesce(F.col("finish_position").cast("string"), F.lit("R")),
            "time": sales.duration_text(F.col("race_duration_ms")),
            "fastestLap": F.col("laps_completed") + 1,
            "rank": F.col("position_order"),
            "fastestLapTime": sales.duration_text(F.col("fastest_lap_ms")),
            "fastestLapSpeed": F.col("fastest_lap_speed_kph").cast("int"),
        }
    else:
        if not repeated:
            # Several stops share a key; with one duration each, any of them may be the newest.
            same = W.partitionBy("race_id", "driver_id", "stop_number")
            rows = rows.withColumn("duration_ms", F.max("duration_ms").over(same))
        cells = {
            "raceId": F.col("race_id"), "driverId": F.col("driver_id"),
            "stop": F.col("stop_number"), "lap": F.col("lap_number"),
            "duration": sales.duration_text(F.col("duration_ms"), minutes=False),
        }
    nothing = F.lit(None).cast("string")
    landing = ENTITIES[name].landing
    return rows.select(*[cells.get(c, nothing).cast("string").alias(c) for c in landing])


def stage(
    spark: SparkSession,
    folder: str,
    root: str,
    names: tuple[str, ...] = tuple(ENTITIES),
    min_season: int | None = None,
    max_season: int | None = None,
) -> None:
    """Write the entities as gzipped CSV, the season ones into season folders."""
    races = source_rows(spark, folder, "races")

    def write(name: str) -> None:
        rows = races if name == "races" else source_rows(spark, folder, name)
        if ENTITIES[name].by_season:
            split = partitioner.with_season(
                rows, races, min_season=min_season, max_season=max_season
            )
            target = f"{root}/{name}"
            if max_season is not None or min_season is not None:
                target += f"/arrival-{min_season or 'first'}"
            partitioner.write_seasons(split.rows, target, null_token=NULL_TOKEN)
        else:
            partitioner.write_whole(rows, f"{root}/{name}", "gzip", NULL_TOKEN)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(write, names))


def _loaded_archive(
    spark: SparkSession, folder: str, names: tuple[str, ...] = tuple(ENTITIES)
) -> tuple[Archive, str]:
    staged = scratch_path(spark, "staged")
    stage(spark, folder, staged, names)
    archive = Archive(spark, scratch_path(spark, "archive"))
    archive.for_each(lambda entity: archive.load(entity, staged, "first", T0), names)
    return archive, staged


def archive_landed(spark: SparkSession, folder: str) -> DataFrame:
    """Per table: rows landed, rows the audit parsed, errors, files missing on either side.

    ``numbered`` says whether the row numbers of every file run from 1 without a gap.
    """
    archive, staged = _loaded_archive(spark, folder)
    audited = archive.audit().groupBy(F.col("target_table").alias("tbl")).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("row_parsed").alias("row_parsed"),
        F.sum("error_count").alias("error_count"),
    )
    numbered, unmatched = None, None
    for name, entity in ENTITIES.items():
        number = F.col("dw_file_row_number")
        place = F.pmod(number, F.lit(64)).cast("int")
        # The numbers of a file as bits of words: as exact as a distinct count, of a row for 64 numbers.
        per_file = (
            archive.landing(entity)
            .groupBy("dw_file_name", F.floor(number / 64).alias("word"))
            .agg(
                F.count("*").alias("n"),
                F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), place)).alias("bits"),
                F.max(number).alias("last"),
            )
            .groupBy("dw_file_name")
            .agg(
                F.sum("n").alias("n"),
                F.sum(F.bit_count("bits")).alias("distinct"),
                F.max("last").alias("last"),
            )
            .agg(
                F.bool_and((F.col("n") == F.col("distinct")) & (F.col("n") == F.col("last"))).alias(
                    "numbered"
                )
            )
            .select(F.lit(name).alias("tbl"), "numbered")
        )
        # Files that hold a header only have no audit row and no rows to miss.
        files = inventory.staged_files(spark, f"{staged}/{name}", entity.file_pattern)
        loaded = archive.ledger(entity)
        gaps = inventory.reconcile(files, loaded).agg(
            F.count_if(F.col("state") != "both").alias("unmatched_files")
        ).select(F.lit(name).alias("tbl"), "unmatched_files")
        numbered = per_file if numbered is None else numbered.unionByName(per_file)
        unmatched = gaps if unmatched is None else unmatched.unionByName(gaps)
    return audited.join(numbered, "tbl").join(unmatched, "tbl")


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Drivers through gzipped CSV and back as landed text."""
    archive, _ = _loaded_archive(spark, folder, ("drivers",))
    return archive.landing(ENTITIES["drivers"]).select(*ENTITIES["drivers"].landing)


def archive_standings(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship answer read from the stored star, all seven files having gone through it."""
    staged = scratch_path(spark, "staged")
    stage(spark, folder, staged)
    archive = Archive(spark, scratch_path(spark, "archive"))
    archive.bring_up(staged, "first", T0)
    progression = views.season_progression(archive.star())
    return to_serving(analysis.final_standings(progression))


def star_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Pit-stop fact after a second load that moves overlong and early stops out of range."""
    entity = ENTITIES["pit_stops"]
    archive, staged = _loaded_archive(spark, folder, ("pit_stops",))
    archive.conform(entity, T0)
    archive.refresh(entity)
    again = source_rows(spark, folder, "pit_stops").withColumn(
        "duration",
        F.when(F.col("stop") == "1", F.lit("0.500"))
        .when(F.col("stop") == "2", F.lit("6:40.000"))
        .when(F.col("stop") == "3", F.lit("1:01.500"))
        .otherwise(F.col("duration")),
    )
    races = source_rows(spark, folder, "races")
    partitioner.write_seasons(
        partitioner.with_season(again, races).rows, f"{staged}/pit_stops/again",
        null_token=NULL_TOKEN,
    )
    archive.load(entity, staged, "second", T1)
    archive.conform(entity, T1, batches=["second"])
    archive.refresh(entity)
    return to_serving(
        archive.star_table(entity).read().select(
            "race_id", "driver_id", "stop_number", "duration_ms", "duration_seconds"
        )
    )


def incremental_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Results arriving in two halves through the stream; the second start takes only the new.

    Per season: rows landed, rows in the typed table, and points.
    """
    entity = ENTITIES["results"]
    staged = scratch_path(spark, "arrivals")
    archive = Archive(spark, scratch_path(spark, "archive"))
    for at, window in ((T0, (None, SPLIT_SEASON)), (T1, (SPLIT_SEASON + 1, None))):
        stage(spark, folder, staged, ("results",), *window)
        query = ingest(archive, entity, staged, clock=lambda at=at: at, upserting=True)
        query.awaitTermination()
        # Nothing new: this start must not land a row.
        ingest(archive, entity, staged, clock=lambda at=at: at, upserting=True).awaitTermination()
    season = F.floor(F.col("race_id") / 100).cast("int").alias("season")
    landed = (
        archive.landing(entity)
        .groupBy(F.substring("raceId", 1, 4).cast("int").alias("season"))
        .agg(F.count("*").alias("landed"))
    )
    typed = archive.typed(entity).groupBy(season).agg(
        F.count("*").alias("rows"),
        F.sum("points").cast("double").alias("points"),
        F.max("dw_inserted_at").cast("timestamp_ntz").alias("arrived"),
    )
    return landed.join(typed, "season")


def shared_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Rows landed after each of four loads that alternate between the stream and the batch.

    Half of the results arrive; the stream takes them, a batch load finds nothing left.  The
    other half arrives; a batch load takes it, and the stream finds nothing left.
    """
    entity = ENTITIES["results"]
    staged = scratch_path(spark, "arrivals")
    archive = Archive(spark, scratch_path(spark, "archive"))
    landed = []
    for at, window, ways in (
        (T0, (None, SPLIT_SEASON), ("stream", "batch")), (T1, (SPLIT_SEASON + 1, None), ("batch", "stream")),
    ):
        stage(spark, folder, staged, ("results",), *window)
        for way in ways:
            if way == "stream":
                ingest(archive, entity, staged, clock=lambda at=at: at).awaitTermination()
            else:
                archive.load(entity, staged, "batch", at)
            landed.append((len(landed) + 1, way, archive.landing(entity).count()))
    return spark.createDataFrame(landed, "step int, way string, landed bigint")


def landed_content(spark: SparkSession, folder: str) -> DataFrame:
    """Per landed column: filled cells, different values, and a checksum of the text.

    Decimals and doubles are compared with four places; stops with equal keys come with
    different durations.
    """
    archive, _ = _loaded_archive(spark, folder)
    parts = []
    for name, entity in ENTITIES.items():
        rows = archive.landing(entity)
        cells = []
        for c in entity.landing:
            text = F.col(f"`{c}`")
            if c in ("lat", "lng", "points"):
                text = text.cast("decimal(18,4)").cast("string")
            cells.append(F.struct(F.lit(c).alias("column_name"), text.alias("value")))
        long = rows.select(F.inline(F.array(*cells))).filter("value is not null")
        # A value's checksum is taken once, however many cells hold it.
        values = long.groupBy("column_name", "value").agg(F.count("*").alias("n"))
        digest = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
        parts.append(
            values.groupBy("column_name").agg(
                F.sum("n").alias("filled"),
                F.count("*").alias("different"),
                F.sum(digest.cast("decimal(20,0)") * F.col("n")).cast("decimal(38,0)").cast("string").alias("checksum"),
            ).select(F.lit(name).alias("tbl"), "*")
        )
    return reduce(DataFrame.unionByName, parts).filter("filled > 0")


def season_partition(spark: SparkSession, folder: str) -> DataFrame:
    """Lines split by the season of their order, within a window, read back from the files.

    Orders still pending are left out of the lookup, so their lines have no season and
    are counted apart.
    """
    orders = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    races = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("year")
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("l_quantity")
    )
    split = partitioner.with_season(lines, races, "l_orderkey", "year", *SEASON_WINDOW)
    path = scratch_path(spark, "seasons")
    partitioner.write_seasons(split.rows, path)
    written = spark.read.csv(
        path, header=True,
        schema="l_orderkey bigint, l_linenumber int, l_quantity bigint, season int",
    )
    measures = [F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity")]
    kept = written.groupBy("season").agg(*measures)
    lost = split.unmatched.agg(*measures).select(
        F.lit(None).cast("int").alias("season"), "rows",
        F.col("quantity").cast("bigint").alias("quantity"),
    )
    return kept.unionByName(lost)


# -- rejects ---------------------------------------------------------------------------

MESSAGES = Entity(
    name="conversations",
    landing=("conv_id", "turn", "role", "text"),
    key="conv_id",
    typed=(("conv_id", "number", "conv_id"),),
)


def _message_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as CSV lines; the user's turns open a quote and never close it."""
    text = F.regexp_replace("text", r'[\s",]+', " ")
    opened = F.when(F.col("role") == "user", F.lit('"')).otherwise(F.lit(""))
    return table(spark, folder, "conversations").select(
        F.concat(
            F.concat_ws(",", F.col("conv_id"), F.col("turn"), F.col("role")),
            F.lit(","), opened, text,
        ).alias("value")
    )


def _judged_messages(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "messages")
    _message_lines(spark, folder).write.text(path)
    # A text writer puts no header into its files.
    return line_source.judged(line_source.read_lines(spark, path), header_lines=0)


def reject_capture(spark: SparkSession, folder: str) -> DataFrame:
    rejected = line_source.rejects(_judged_messages(spark, folder), MESSAGES, T0)
    return rejected.select(
        "target_table", "error_message", "character_pos", "rejected_record",
        F.col("recorded_at").cast("timestamp_ntz").alias("recorded_at"),
    )


def audit_record(spark: SparkSession, folder: str) -> DataFrame:
    """Rows added by the audit step when it is run once, and again with nothing new."""
    rows = table(spark, folder, "documents").select(
        F.col("lang").alias("target_table"), F.col("source").alias("file_name"),
        F.lit(T0).cast("timestamp").alias("last_load_time"),
    )
    none = spark.createDataFrame(
        [], "target_table string, file_name string, last_load_time timestamp,"
        " line_number bigint, error_message string",
    )
    history = audit.load_history(rows, none)
    archive = Archive(spark, scratch_path(spark, "archive"))
    calls = [(n, archive.record_history(history, T0, hours)) for n, hours in ((1, 24), (2, 24))]
    total = archive.audit().agg(F.sum("row_count").alias("row_count"))
    inserted = spark.createDataFrame(calls, "call int, inserted bigint")
    label = F.lit(MESSAGES.name).alias("k")
    return inserted.select("*", label).join(total.select("*", label), "k").drop("k")


def newest_stops(spark: SparkSession, folder: str) -> DataFrame:
    """Stops of one key with different durations, all in one file: the last line wins.

    Per key: rows staged and the duration kept.  The files of a season hold whole keys, each in
    the order of the durations, so the longest stop of a key stands last.
    """
    rows = source_rows(spark, folder, "pit_stops", repeated=True).select(
        "raceId", "driverId", "stop", "lap", F.lit(None).cast("string").alias("time"), "duration",
        F.lit(None).cast("string").alias("milliseconds"),
    )
    staged = scratch_path(spark, "stops")
    season, length = F.substring("raceId", 1, 4).alias("season"), F.col("duration").cast("decimal(18,3)")
    partitioner.write_sorted(
        rows.select("*", season).repartition("raceId", "driverId", "stop"), f"{staged}/pit_stops",
        length, null_token=NULL_TOKEN,
    )
    archive = Archive(spark, scratch_path(spark, "archive"))
    entity = replace(ENTITIES["pit_stops"], by_season=False)
    loaded = line_source.read_lines(spark, f"{staged}/pit_stops")
    archive.land(entity, loaded, "first", T0)
    archive.conform(entity, T0)
    counted = rows.groupBy(
        F.col("raceId").cast("bigint").alias("race_id"), F.col("driverId").cast("bigint").alias("driver_id"),
        F.col("stop").cast("int").alias("stop_number"),
    ).agg(F.count("*").alias("staged"))
    return archive.typed(entity).select("race_id", "driver_id", "stop_number", "duration_ms").join(
        counted, ["race_id", "driver_id", "stop_number"]
    )


TEXTS = Entity(
    name="texts",
    landing=("doc_id", "text", "lang"),
    key="doc_id",
    typed=(("doc_id", "number", "doc_id"),),
)


def multiline_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, through quoted CSV, plain and gzipped.

    Per document: the checksum of its landed text, its lines, and whether it was rejected.
    """
    path = scratch_path(spark, "texts")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    records = table(spark, folder, "documents").select(
        "doc_id", F.concat_ws(",", F.col("doc_id"), quoted, F.col("lang")).alias("value")
    )
    for part, options in ((0, {}), (1, {"compression": "gzip"})):
        records.filter(F.col("doc_id") % 2 == part).select("value").write.options(**options).text(f"{path}/{part}")
    judged = line_source.judged(line_source.read_lines(spark, path), header_lines=0)
    landed = line_source.landed(judged.filter("error is null"), TEXTS, T0)
    return landed.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.md5("text").alias("checksum"),
        F.size(F.split("text", "\n")).cast("bigint").alias("lines"),
    )


def metric_history(spark: SparkSession, folder: str) -> DataFrame:
    """Newest stored metrics after two runs, of which the second changes and measures nothing."""
    staged = scratch_path(spark, "staged")
    stage(spark, folder, staged)
    archive = Archive(spark, scratch_path(spark, "archive"))
    for at in (T0, T1):
        archive.bring_up(staged, "run", at)
    return verification.latest_metrics(archive).select(
        *quality.RESULT_KEY, "metric_value", "status",
        F.col("measurement_time").cast("timestamp_ntz").alias("measurement_time"),
    ).filter("metric_name <> 'FRESHNESS'")


def prepared_files(spark: SparkSession, folder: str) -> DataFrame:
    """Results and pit stops per season after a source folder was laid out, text kept."""
    source, target = scratch_path(spark, "source"), scratch_path(spark, "prepared")

    def write(name: str) -> None:
        rows = source_rows(spark, folder, name, repeated=True)
        if name == "results":
            # Leading zeros and padding are text and have to survive.
            rows = rows.withColumn("grid", F.concat(F.lit("0"), "grid", F.lit(" ")))
        partitioner.write_whole(rows, f"{source}/{name}.csv", null_token=NULL_TOKEN)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(write, ENTITIES))
    files = partitioner.prepare(spark, source, target, *SEASON_WINDOW)
    if not files:
        raise ValueError("no file was written")
    written = partitioner.read_source(spark, f"{target}/results")
    season = F.substring("raceId", 1, 4).cast("int").alias("season")
    return written.groupBy(season).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("grid").rlike("^0[0-9]+ $")).alias("padded"),
        F.count_if(F.col("position") == NULL_TOKEN).alias("unplaced"),
        F.sum(F.col("points").cast("decimal(18,2)")).cast("double").alias("points"),
    )


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects per table, next to the records that landed."""
    judged = _judged_messages(spark, folder)
    rejected = audit.rejects_per_table(line_source.rejects(judged, MESSAGES, T0))
    good = judged.filter(F.col("error").isNull())
    landed = line_source.landed(good, MESSAGES, T0).agg(F.count("*").alias("landed")).select(
        F.lit(MESSAGES.name).alias("target_table"), "landed"
    )
    return landed.join(rejected, "target_table", "left").fillna(0, ["reject_count"])


QUERIES: dict[str, Query] = {
    "upsert_snapshot": upsert_snapshot,
    "upsert_report": upsert_report,
    "csv_roundtrip": csv_roundtrip,
    "archive_landed": archive_landed,
    "archive_standings": archive_standings,
    "star_refresh": star_refresh,
    "incremental_ingest": incremental_ingest,
    "season_partition": season_partition,
    "reject_capture": reject_capture,
    "reject_counts": reject_counts,
    "audit_record": audit_record,
    "metric_history": metric_history,
    "shared_ledger": shared_ledger,
    "landed_content": landed_content,
    "newest_stops": newest_stops,
    "multiline_records": multiline_records,
    "prepared_files": prepared_files,
}
