"""Column access, ordered running totals and document classes shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.session import stored

# The characters that separate words: space, tab, line feed, vertical tab, form feed, return.
SEPARATORS = "[ \\t\\n\\x0B\\f\\r]"

# Bits of the map that `marked` broadcasts: 4 MB, however many hashes there are; a page has 4 KB.
MAP_BITS = 1 << 25
PAGE_BITS = 1 << 15


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, whatever else the frame carries.

    Columns are found by position, so extra columns that differ only in case, or that
    are called like an operator's own columns, do no harm.
    """
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.select(
        *[by_place[f"c{df.columns.index(name)}"].alias(name) for name in names]
    )


def with_row(df: DataFrame, *names: str) -> DataFrame:
    """The named columns beside ``row``, a struct of every column as it came."""
    by_place = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return by_place.select(
        *[by_place[f"c{df.columns.index(name)}"].alias(name) for name in names],
        F.struct(*[by_place[c] for c in by_place.columns]).alias("row"),
    )


def rows_of(df: DataFrame, like: DataFrame) -> DataFrame:
    """The rows packed by `with_row`, under their first names."""
    return df.select("row.*").toDF(*like.columns)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters that are not separators; null gives an empty list."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS + "+"), "")


def marked(rows: DataFrame, name: str, found: DataFrame) -> DataFrame:
    """``rows`` with ``marked``, which is true wherever their hash ``name`` is one in ``found``.

    The hashes of ``found`` set bits of a map that is broadcast and never larger than
    `MAP_BITS`.  Rows may be marked in vain, more of them the more hashes there are, so an
    exact join has to follow; what is not marked need not be shuffled for it.
    """
    slot = F.col(name).bitwiseAND(MAP_BITS - 1)
    page, bit = F.floor(slot / PAGE_BITS).cast("int"), slot.bitwiseAND(PAGE_BITS - 1).cast("int")
    pages = (
        found.select(page.alias("page"), bit.alias("bit")).repartition("page")
        .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3) + 1, 1)), 16, 10).cast("int")
    return (
        rows.withColumn("page", page).join(F.broadcast(pages), "page", "left")
        .withColumn("marked", F.coalesce(F.getbit(byte, bit.bitwiseAND(7)) == 1, F.lit(False)))
        .drop("page", "bits")
    )


def running_totals(
    rows: DataFrame, order: Sequence[str], totals: dict[str, str], label: str
) -> DataFrame:
    """Each row with, for ``{new: amount}``, the sum of ``amount`` over the rows before it.

    Rows are range-partitioned by ``order`` and stored once with their partition's number;
    sums run within a partition and start from the totals of the partitions before it, of
    which there is one row each.  ``all_<new>`` is the total over all rows.  A random third
    key, stored with the rows, spreads repeated rows over partitions.
    """
    placed = stored(
        rows.withColumn("tie", F.rand(1))
        .repartitionByRange(*order, "tie")
        .withColumn("part", F.spark_partition_id()),
        label,
    )
    sums = placed.groupBy("part").agg(*[F.sum(a).alias(f"sum_{n}") for n, a in totals.items()])
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bases = sums.select(
        "part",
        *[F.coalesce(F.sum(f"sum_{n}").over(ahead), F.lit(0)).alias(f"base_{n}") for n in totals],
        *[F.sum(f"sum_{n}").over(everything).alias(f"all_{n}") for n in totals],
    )
    inside = (
        Window.partitionBy("part")
        .orderBy(*order, "tie")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    within = placed.select(
        "*", *[F.coalesce(F.sum(a).over(inside), F.lit(0)).alias(n) for n, a in totals.items()]
    )
    # One row for each partition of the stored table.
    return within.join(F.broadcast(bases), "part").select(
        *rows.columns,
        *[(F.col(n) + F.col(f"base_{n}")).alias(n) for n in totals],
        *[f"all_{n}" for n in totals],
    )


def packed_text(text: str | None) -> bytes | None:
    """The size of the UTF-8 text and its compressed bytes."""
    if text is None:
        return None
    data = text.encode()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else bytes(8)


def unpacked(packed: bytes | None) -> bytes:
    size = int.from_bytes(packed[:8], "little") if packed else 0
    return pa.decompress(packed[8:], size, codec="zstd", asbytes=True) if size else b""
