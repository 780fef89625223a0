"""Exactly-once ingest of newly arrived files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapwise.plans.pipeline import Archive
from lapwise.sources.entities import Entity

Clock = Callable[[], dt.datetime]

# The columns of a binary file row; the content is never asked for, so it is never read.
FILE_ROW = "path string, modificationTime timestamp, length bigint, content binary"


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def arriving_files(archive: Archive, entity: Entity, staged_root: str, **options: str) -> DataFrame:
    """Name, size and time of the entity's files as they arrive, whatever they hold.

    ``maxFileAge`` is lifted far beyond the default week: an old-dated file that arrives
    late is still new.
    """
    files = (
        archive.spark.readStream.format("binaryFile")
        .schema(FILE_ROW)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")
        .options(**options)
        .load(f"{staged_root}/{entity.name}")
    )
    return files.select(
        F.col("path").alias("file_name"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("file_modified"),
    ).filter(F.col("file_name").rlike(entity.file_pattern))


def ingest(
    archive: Archive,
    entity: Entity,
    staged_root: str,
    clock: Clock = _utc_now,
    upserting: bool = False,
    processing_time: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start the query; by default it takes what is there and stops.

    The stream is one of files, not of their lines.  A micro-batch takes those that the
    archive's ledger does not hold, which batch loads write as well, so no file lands twice
    whichever way it came, and a file without records has its audit row.  What a micro-batch
    writes is named after the query's id, which belongs to its checkpoint, and its own: a replay
    finds its files in the ledger or overwrites what did not count.  With ``upserting`` each
    batch also goes through the typed table, the star and the metrics; repeating that is harmless,
    since unchanged hashes write nothing and only listed buckets are followed up.
    """

    def take(files: DataFrame, batch_id: int) -> None:
        now = clock()
        query_id = archive.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        archive.take(entity, files, f"stream-{query_id}-{batch_id:09d}", now, replay=True)
        if upserting:
            archive.catch_up(entity, now)
            archive.measure(now, [entity.name])

    files = arriving_files(archive, entity, staged_root, **options)
    writer = files.writeStream.foreachBatch(take).option(
        "checkpointLocation", f"{archive.root}/checkpoints/{entity.name}"
    )
    if processing_time is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=processing_time).start()
