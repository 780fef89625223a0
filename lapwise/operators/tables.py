"""Parquet tables in folders by bucket, rewritten bucket by bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.session import COMPRESSION, release

BUCKET = "bucket"
PRESENT = "present"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path``; one request, no job."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def table_at(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet rows under ``path``; none if nothing was written there yet."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


class BucketTable:
    """A table whose buckets are replaced as a whole and only where a write touches them.

    Writes use Spark's dynamic partition overwrite: new files are staged until every task
    has succeeded, so a failed job leaves the old rows.  One writer per table at a time.  A
    bucket left without rows keeps a row that is not ``present``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def read(self) -> DataFrame:
        """Current rows; ``bucket`` is kept as a column."""
        stored = T.StructType(
            [
                *self.schema.fields,
                T.StructField(PRESENT, T.BooleanType()),
                T.StructField(BUCKET, T.LongType()),
            ]
        )
        return table_at(self.spark, self.path, stored).filter(PRESENT).drop(PRESENT)

    def replace(self, rows: DataFrame, buckets: DataFrame, gathered: bool = False) -> None:
        """Make ``rows`` the whole content of the listed ``buckets``.

        The rebalance hint lets AQE split a bucket that is too large for one writer.  Rows
        ``gathered`` by bucket, as those read from such a table are, go without that shuffle.
        """
        absent = buckets.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields],
            F.lit(False).alias(PRESENT),
            BUCKET,
        )
        present = rows.select(*self.schema.fieldNames(), F.lit(True).alias(PRESENT), BUCKET)
        if gathered:
            whole = present.unionByName(absent.hint("rebalance", BUCKET))
        else:
            whole = present.unionByName(absent).hint("rebalance", BUCKET)
        (
            whole.write.mode("overwrite")
            .option("compression", COMPRESSION)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        release(self.spark)
