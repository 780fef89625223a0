"""Blocks of whole-number vectors and the joins that lead groups of queries to them.

A block is one stored row that holds up to `BLOCK_BYTES` of vectors, rows near each other
together; a chunk holds queries in the same way.  Bounds are computed between the narrow
summaries of blocks and chunks first, and only pairs that pass meet with their vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.vector_rows import common_length, grid, usable
from lapwise.session import stored

# Vectors of a block, in bytes and at most in rows; rows a sample for pivots or centres holds.
BLOCK_BYTES = 1 << 21
BLOCK_ROWS = 4096
SAMPLE_ROWS = 1024

# Block summaries that travel together, and chunks that one copy of them serves.
SUMMARY_ROWS = 1024
SUMMARY_CHUNKS = 16


def whole_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, *others: str) -> tuple[DataFrame, int]:
    """``vec_id, x, ...`` of the rows that take part, and the length of ``x``.

    Of usable vectors, without null ids or ``others``, those of the most frequent length; ``x`` is ``floor(scale * entry)``, and
    rows with an ``x`` so large that an inner product could leave a long are left out.
    """
    rows = usable(vectors, id_col, vector_col, *others).dropna("any", subset=["vec_id", *others])
    size = common_length(rows)
    x, inside = grid(scale, 0, math.isqrt(((1 << 63) - 1) // max(size, 1)) - 1)
    rows = rows.where((F.size("vector") == size) & inside)
    return rows.select("vec_id", x.alias("x"), *others), size


def classes(rows: DataFrame, keep: int, *others: str) -> DataFrame:
    """``ids, x, ...``: each different vector (with its ``others``) once, its ``keep`` smallest ids.

    More ids of one vector cannot be among the first ``keep`` of any ranking.  They are cut
    off before the shuffle, so copies of one vector never gather in a task.
    """
    same = Window.partitionBy(F.xxhash64("x"), "x", *others).orderBy("vec_id")
    return (
        rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= keep)
        .groupBy(F.xxhash64("x").alias("h"), "x", *others)
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select("ids", "x", *others)
    )


def asked(rows: DataFrame, step: int, *others: str) -> DataFrame:
    """``ids`` (query id and number among rows of one id), ``x``, ``...`` of each query row."""
    own = Window.partitionBy("vec_id").orderBy("x", *others)
    return (
        rows.where(F.col("vec_id") % step == 0)
        .withColumn("copy", F.row_number().over(own).cast("long"))
        .select(F.array("vec_id", "copy").alias("ids"), "x", *others)
    )


def sample(rows: DataFrame, size: int, count: int = SAMPLE_ROWS) -> np.ndarray:
    """Up to ``count`` vectors, those with the smallest hashes; the same for every run."""
    first = rows.select("x").orderBy(F.xxhash64("x"), "x").limit(count).collect()
    return np.array([r["x"] for r in first], np.float64).reshape(-1, size)


def matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy().reshape(-1, size)


def placed(rows: DataFrame, place, size: int) -> DataFrame:
    """``rows`` with ``cell`` and ``near`` from ``place(x)``, range-partitioned and sorted by both."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, near = place(matrix(batch, "x", size).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near.astype(np.float64))],
                names=[*batch.schema.names, "cell", "near"],
            )

    columns = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return (
        rows.mapInArrow(add, f"{columns}, cell int, near double")
        .repartitionByRange("cell", "near", F.xxhash64("x"))
        .sortWithinPartitions("cell", "near")
    )


def packed(rows: DataFrame, place, describe, size: int, most: int, label: str, extra: str = "") -> DataFrame:
    """Blocks of up to ``most`` neighbouring rows, stored.

    ``describe(x, batch)`` gives the values of the further columns ``extra`` of a block.
    Columns: ``block long, ids array<array<long>>, x binary`` and those.
    """
    schema = "block long, ids array<array<bigint>>, x binary" + (f", {extra}" if extra else "")
    kinds = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, count, number = TaskContext.get().partitionId() << 32, [], 0, 0

        def block(part: pa.Table) -> pa.RecordBatch:
            x = part["x"].combine_chunks().flatten().to_numpy().reshape(-1, size)
            values = [base + number, part["ids"].to_pylist(), np.ascontiguousarray(x, "<i8").tobytes()]
            values += describe(x.astype(np.float64), part)
            types = [pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], types[i] if i < 3 else None) for i, v in enumerate(values)], names=kinds
            )

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            while count >= 2 * most:
                table = pa.Table.from_batches(held)
                yield block(table.slice(0, most))
                number, held, count = number + 1, table.slice(most).to_batches(), count - most
        # What is left is cut evenly.
        if count:
            table = pa.Table.from_batches(held)
            pieces = -(-count // most)
            edges = [count * i // pieces for i in range(pieces + 1)]
            for begin, end in zip(edges, edges[1:]):
                yield block(table.slice(begin, end - begin))
                number += 1

    return stored(placed(rows, place, size).mapInArrow(cut, schema), label)


def block_rows(size: int) -> int:
    return max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * size)))


def pairs(blocks: DataFrame, chunks: DataFrame, summary: list[str], compare, label: str) -> DataFrame:
    """``chunk, block, wanted`` (places of the chunk's queries) of the pairs worth a visit.

    ``summary`` names the blocks' narrow columns; ``compare(summaries, chunk)`` takes lists of them
    and a chunk's row and yields block and places.  Summaries travel in groups, each
    group once for some chunks, so neither side is collected anywhere.
    """
    groups = max(1, -(-blocks.count() // SUMMARY_ROWS))
    shares = max(1, -(-chunks.count() // SUMMARY_CHUNKS))
    gathered = (
        blocks.select("block", *summary)
        .groupBy(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("g"))
        .agg(F.collect_list(F.struct("block", *summary)).alias("summaries"))
        .select("g", "summaries", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("s"))
    )
    spread = chunks.withColumn("s", F.pmod(F.xxhash64("chunk"), F.lit(shares))).withColumn(
        "g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    )

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                out = list(compare(row.pop("summaries").values, row))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["chunk"].as_py()] * len(out)),
                         pa.array([b for b, _ in out], pa.int64()),
                         pa.array([w for _, w in out], pa.list_(pa.int32()))],
                        names=["chunk", "block", "wanted"],
                    )

    joined = spread.join(gathered, ["g", "s"]).drop("g", "s")
    return stored(joined.mapInArrow(look, "chunk long, block long, wanted array<int>"), label)


def visits(pairs: DataFrame, chunks: DataFrame, blocks: DataFrame, visit, schema: str) -> DataFrame:
    """Rows that ``visit(block, chunk, wanted)`` yields (as record batches) for each pair.

    Chunks go to the blocks they visit; the blocks' vectors are shuffled once.
    """
    index = blocks.select(*[F.col(c).alias(c if c == "block" else f"b_{c}") for c in blocks.columns])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                block = {n[2:]: v for n, v in row.items() if n.startswith("b_")}
                yield from visit(block, row, row["wanted"].values.to_numpy())

    return pairs.join(chunks, "chunk").join(index, "block").mapInArrow(walk, schema)


def numbers(cell: pa.Scalar, size: int, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), kind).reshape(-1, size)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right.T`` of whole numbers, exactly, as longs: in doubles where these are exact."""
    if not left.size or not right.size:
        return np.zeros((len(left), len(right)), np.int64)
    most = int(np.abs(left).max()) * int(np.abs(right).max()) * left.shape[1]
    if most < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    return left @ right.T


def first_classes(score: np.ndarray, ids: pa.Scalar, place: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """``(score, id)`` of the ``wanted`` first rows of some classes, ties to the smaller id.

    ``place`` are the classes' places in ``ids``, whose lists are sorted.
    """
    lists = ids.values
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy()
    heads = flat[offsets[place]]
    order = np.lexsort((heads, -score))[:wanted]
    rows = [
        (int(score[o]), int(i))
        for o in order
        for i in flat[offsets[place[o]] : offsets[place[o] + 1]]
    ]
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:wanted]


def first_rows(found: DataFrame, keys: list[str], wanted: Column | int) -> DataFrame:
    """The first ``wanted`` rows of each key by falling score, then id, with their ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def without_own(found: DataFrame, keys: list[str], own_score: str, wanted: int) -> DataFrame:
    """Each key's first ``wanted`` rows, its own row (own score and id, once) left out.

    ``found`` holds up to ``wanted + 1`` rows a key, and ``own_score`` in each of them.
    """
    is_own = (F.col("score") == F.col(own_score)) & (F.col("vec_id") == F.col(keys[0]))
    nth = F.row_number().over(Window.partitionBy(*keys, is_own).orderBy("rank"))
    order = Window.partitionBy(*keys).orderBy("rank")
    return (
        found.withColumn("nth", nth)
        .where(~is_own | (F.col("nth") > 1))
        .withColumn("rank", F.row_number().over(order).cast("int"))
        .where(F.col("rank") <= wanted)
    )
