"""Contiguous shards of near equal bytes, from prefix sums of row sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import pick, running_totals

# Bytes every row counts beside its text.
ROW_OVERHEAD = 16


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    whole_share: float = 0.05,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    Rows are ordered by the digest of their text, then by id, and the running sum of sizes
    is cut at ``shards`` equal targets: a row goes where the middle of its bytes falls.
    Equal texts are neighbours in that order; a group of them that is no larger than
    ``whole_share`` of a shard is placed by its own middle and so stays together, a larger
    group is cut by rows like everything else.  Shards are contiguous in the order.

    A null text counts as empty (crc 0).  Null ids come first.  Repeated rows are kept,
    each with its own slot.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running_totals(
        rows, ["digest", "doc_id"], {"before": "size", "index": "one"}, "shard-rows"
    )
    by_row = placed.withColumn("own", F.expr(
        f"cast(least((2 * before + size) * {shards} div (2 * all_before), {shards - 1}) as int)"
    ))
    ends = by_row.groupBy("own").agg(
        F.min_by("digest", "index").alias("first"), F.max_by("digest", "index").alias("last")
    )
    # Only a group that begins a shard and ends another can have a cut through it; the middle of
    # any other lies in its rows' own shard.  At most ``shards`` digests.
    through = ends.select(F.col("first").alias("digest")).intersect(ends.select("last"))
    groups = placed.join(F.broadcast(through), "digest").groupBy("digest").agg(
        F.min("before").alias("group_start"), F.sum("size").alias("group_bytes")
    )
    whole = F.col("group_bytes") * shards <= F.col("all_before") * whole_share
    cut = by_row.join(F.broadcast(groups), "digest", "left").withColumn(
        "shard",
        F.when(whole, F.expr(
            f"cast(least((2 * group_start + group_bytes) * {shards} div (2 * all_before), {shards - 1}) as int)"
        )).otherwise(F.col("own")),
    )
    firsts = cut.groupBy("shard").agg(F.min("index").alias("first_index"))
    # At most ``shards`` rows.
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("index") - F.col("first_index")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
