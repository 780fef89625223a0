"""What is staged, what is loaded, and the difference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_KEY = ["file_name", "file_size", "file_modified"]


def staged_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Every file under ``root`` with size and time; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(
            F.col("path").alias("file_name"),
            F.col("length").alias("file_size"),
            F.col("modificationTime").alias("file_modified"),
        )
    )
    return files if pattern is None else files.filter(F.col("file_name").rlike(pattern))


def pending(staged: DataFrame, ledger: DataFrame | None, force: bool = False) -> DataFrame:
    """Staged files the ledger does not hold; a rewritten file counts as new."""
    if force or ledger is None:
        return staged
    return staged.join(ledger.select(*FILE_KEY), FILE_KEY, "left_anti")


def reconcile(staged: DataFrame, loaded: DataFrame) -> DataFrame:
    """Each file name with where it was seen: ``both``, ``staged_only`` or ``loaded_only``."""
    left = staged.select("file_name").distinct().withColumn("staged", F.lit(True))
    right = loaded.select("file_name").distinct().withColumn("loaded", F.lit(True))
    return left.join(right, "file_name", "full_outer").select(
        "file_name",
        F.when(F.col("staged") & F.col("loaded"), "both")
        .when(F.col("staged"), "staged_only")
        .otherwise("loaded_only")
        .alias("state"),
    )
