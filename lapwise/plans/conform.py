"""Landing text to typed rows: cast, rename, newest per key, change hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions import change_hash, descending, exact_hash
from lapwise.operators.ordered import newest
from lapwise.operators.tables import BUCKET
from lapwise.sources.entities import Entity


def newest_landed(landing: DataFrame, entity: Entity) -> DataFrame:
    """The newest arrival of each key, still text, rows with an unparsable key left out.

    Newest is by load time, then row number; file name and content settle the rest, so
    that reruns agree.  Only the key is parsed before the choice; the other columns are
    cast once per key however many generations of it were landed.
    """
    key = entity.identity()
    order = [
        descending("dw_loaded_at"), descending("dw_file_row_number"), descending("dw_file_name"),
        F.xxhash64(*[F.col(c) for c in entity.sources()]).desc(),
    ]
    rows = landing.withColumn("__key", key)
    for column in entity.required_columns:
        rows = rows.filter(entity.expression(column).isNotNull())
    bucket_ = [BUCKET] if BUCKET in landing.columns else []
    return newest(rows, ["__key"], order).select(*entity.sources(), "dw_file_name", *bucket_)


def projected(landing: DataFrame, entity: Entity) -> DataFrame:
    """Landed rows cast and renamed, row by row."""
    return landing.select(*entity.projection(), F.col("dw_file_name").alias("dw_source_file"))


def typed(landing: DataFrame, entity: Entity) -> DataFrame:
    """One typed row per key: the newest arrival, rows with an unparsable key left out."""
    return projected(newest_landed(landing, entity), entity)


def with_hash(rows: DataFrame, entity: Entity, narrow: bool = False, text: bool = False) -> DataFrame:
    """Add ``row_hash``; lineage is never part of it.

    ``narrow`` hashes the entity's short column list, ``text`` uses the separator form.
    """
    digest = change_hash if text else exact_hash
    return rows.withColumn("row_hash", digest(entity.hash_columns(narrow)))


def bucket(entity: Entity, width: int, value: Column | None = None) -> Column:
    """Bucket of a row, fixed by its key; ``value`` stands for the column it is made of.

    Entities with a bucket column put ``width`` neighbouring values of it into a bucket, the
    others spread the hashes of their keys over ``width`` buckets.
    """
    value = F.col(entity.bucket_on or entity.key) if value is None else value
    if entity.bucket_on is None:
        return F.pmod(F.xxhash64(value), F.lit(width)).cast("bigint")
    return F.floor(value / width).cast("bigint")


def conformed(landing: DataFrame, entity: Entity, narrow: bool = False) -> DataFrame:
    return with_hash(typed(landing, entity), entity, narrow)


def arrivals(landing: DataFrame, entity: Entity, width: int) -> DataFrame:
    """Rows that can be upserted, still text, with their bucket; some may be of one key."""
    rows = landing
    for column in entity.required_columns:
        rows = rows.filter(entity.expression(column).isNotNull())
    value = entity.expression(entity.bucket_on or entity.key)
    return rows.withColumn(BUCKET, bucket(entity, width, value))


def finished(rows: DataFrame, entity: Entity, narrow: bool = False) -> DataFrame:
    """Newest landed rows with a bucket as typed rows with key and change hash, row by row."""
    lineage = F.col("dw_file_name").alias("dw_source_file")
    return with_hash(rows.select(*entity.projection(), lineage, BUCKET), entity, narrow)


def table_schema(landing: DataFrame, entity: Entity) -> T.StructType:
    """Stored columns: business columns, hash, source file and the two change times."""
    rows = conformed(landing, entity)
    stamps = [
        T.StructField(c, T.TimestampType()) for c in ("dw_inserted_at", "dw_updated_at")
    ]
    fields = [T.StructField(f.name, f.dataType) for f in rows.schema.fields]
    return T.StructType(fields + stamps)
