"""Exact top-k search by inner product, with candidates eliminated by a pivot table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.vector_blocks import (
    asked, block_rows, classes, first_classes, first_rows, numbers, packed, pairs, products, sample,
    visits, whole_vectors, without_own,
)
from lapwise.session import stored

# Pivots besides the origin, queries of a chunk, and candidates evaluated between two looks
# at the stopping bound.
PIVOTS = 32
CHUNK_QUERIES = 1024
STEP = 128

# Rows that a query meets before anything is ruled out: a block, or several small ones.
HOME_ROWS = 2048

# Bounds are widened by this share of the squared norms, far above the rounding of doubles.
SLACK = 1e-9

FOUND = "query_id long, copy long, chunk long, place int, own long, score long, vec_id long"


def spread_out(rows: np.ndarray, count: int) -> np.ndarray:
    """The origin and up to ``count`` of ``rows``, each the one farthest from those before."""
    chosen = np.zeros((1, rows.shape[1]))
    far = np.linalg.norm(rows, axis=1)
    while len(chosen) <= count and far.size and far.max() > 0:
        chosen = np.vstack([chosen, rows[far.argmax()]])
        far = np.minimum(far, np.linalg.norm(rows - chosen[-1], axis=1))
    return chosen


def pivot_table(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of each row to each pivot, the first being the origin."""
    squares = (rows * rows).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (rows @ pivots.T)
    out = np.sqrt(np.maximum(squares, 0))
    out[:, 0] = np.sqrt((rows * rows).sum(1))
    return out


def score_bounds(norms: np.ndarray, tops: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """The greatest possible inner products, given lower bounds of the distances."""
    squares = (norms * norms)[:, None] + tops * tops
    return (squares - apart * apart) / 2 + SLACK * (squares + 1)


def worth_visiting(first: bool, count: int):
    """For `pairs`: each query's most promising blocks, or all others that can still matter."""

    def compare(summaries: pa.Array, chunk: dict):
        ids = summaries.field("block").to_numpy()
        low = np.stack(summaries.field("low").to_numpy(zero_copy_only=False))
        high = np.stack(summaries.field("high").to_numpy(zero_copy_only=False))
        table = numbers(chunk["table"], count, "<f8")
        apart = np.zeros((len(table), len(ids)))
        for p in range(count):
            mine = table[:, p : p + 1]
            np.maximum(apart, np.maximum(mine - high[:, p], low[:, p] - mine), out=apart)
        bounds = score_bounds(table[:, 0], high[:, 0], apart)
        # A block's number breaks ties, so both rounds agree on the first ones.
        order = np.argsort(ids)
        ranked = order[np.argsort(-bounds[:, order], axis=1, kind="stable")]
        sizes = summaries.field("rows").to_numpy()[ranked]
        home = np.zeros(bounds.shape, bool)
        np.put_along_axis(home, ranked, np.cumsum(sizes, axis=1) - sizes < HOME_ROWS, axis=1)
        chosen = home if first else (bounds >= chunk["least"].values.to_numpy()[:, None]) & ~home
        for b in np.flatnonzero(chosen.any(0)):
            yield int(ids[b]), np.flatnonzero(chosen[:, b]).astype(np.int32)

    return compare


def eliminate(size: int, count: int, wanted: int):
    """For `visits`: candidates in the order of their bounds, until none left can be among the first."""

    def visit(block: dict, chunk: dict, places: np.ndarray):
        rows, queries = numbers(block["x"], size), numbers(chunk["x"], size)[places]
        theirs, mine = numbers(block["table"], count, "<f8"), numbers(chunk["table"], count, "<f8")[places]
        least = chunk["least"].values.to_numpy()[places]
        names = chunk["ids"].values.flatten().to_numpy().reshape(-1, 2)[places]
        columns = theirs.T.copy()
        out = []
        for begin in range(0, len(places), 64):
            part = mine[begin : begin + 64]
            apart = np.zeros((len(part), len(rows)))
            for p in range(count):
                np.maximum(apart, np.abs(part[:, p : p + 1] - columns[p]), out=apart)
            bounds = score_bounds(part[:, 0], columns[0], apart)
            for q in range(len(part)):
                at = begin + q
                floor = least[at]
                left = np.flatnonzero(bounds[q] >= floor)
                left = left[np.argsort(-bounds[q][left], kind="stable")]
                ends = -bounds[q][left]
                score, seen = np.zeros(0, np.int64), 0
                step = STEP
                while seen < len(left) and -ends[seen] >= floor:
                    # Up to where the bounds fall below the floor, a step at a time.
                    upto = min(seen + step, int(np.searchsorted(ends, -floor, "right")))
                    score = np.append(score, products(queries[at : at + 1], rows[left[seen:upto]])[0])
                    seen, step = upto, 2 * step
                    if len(score) >= wanted:
                        floor = max(floor, np.partition(score, len(score) - wanted)[len(score) - wanted])
                near = np.flatnonzero(score >= floor)
                if len(near):
                    own = int(products(queries[at : at + 1], queries[at : at + 1])[0, 0])
                    found = first_classes(score[near], block["ids"], left[near], wanted)
                    out += [(*names[at].tolist(), int(places[at]), own, s, i) for s, i in found]
        if out:
            query, copy, place, own, score, ids = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(copy), pa.array([chunk["chunk"].as_py()] * len(out)),
                 pa.array(place, pa.int32()), pa.array(own), pa.array(score), pa.array(ids)],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return visit


def search(
    vectors: DataFrame,
    query_step: int = 50,
    k: int = 5,
    scale: int = 256,
    pivots: int = PIVOTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score, copy``: the ``k`` highest scores of each query, exactly.

    Entries become ``floor(scale * entry)``; the score is the integer inner product.  Queries are the
    rows whose id is divisible by ``query_step``, candidates all rows but the query's own;
    ties go to the smaller id.  Distances of all rows to the pivots are computed once.
    By the triangle inequality the largest difference of a query's and a candidate's distance to
    one pivot is a lower bound of theirs, which bounds the score from above.  Each query first
    visits its most promising blocks; its ``k``-th score rules out blocks by the
    ranges of their distances, and in the others candidates are evaluated in the order of
    their bounds until the next bound is too small.  Pivots come from a bounded sample; they
    decide the work, never the result.

    Vectors that are null, empty or hold a null or non-finite component take no part, nor do null
    ids, vectors of another length than the most frequent one (of equally frequent
    lengths, the greater) and components so large that a score could leave a long.  Zero
    vectors score 0.  Rows of one id are rows of their own: each asks for itself, told
    apart by ``copy`` (from 1, in the order of their vectors), and only itself is not its candidate.
    Copies of a vector are candidates each.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score long, copy int"
    rows, size = whole_vectors(vectors, scale, id_col, vector_col)
    if not size:
        return spark.createDataFrame([], result)
    wanted = k + 1
    index = stored(classes(rows, wanted), "pivot-classes")
    table = spread_out(sample(index, size), pivots)
    count = len(table)

    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = pivot_table(x, table)[:, 1:] if count > 1 else pivot_table(x, table)
        return far.argmin(1), far.min(1)

    def describe(x: np.ndarray, part: pa.Table) -> list:
        far = pivot_table(x, table)
        return [len(x), np.ascontiguousarray(far, "<f8").tobytes(), far.min(0).tolist(), far.max(0).tolist()]

    extra = "rows bigint, table binary, low array<double>, high array<double>"
    blocks = packed(index, place, describe, size, block_rows(size), "pivot-blocks", extra)
    chunks = packed(
        asked(rows, query_step), place, describe, size, min(CHUNK_QUERIES, block_rows(size)), "pivot-chunks", extra
    ).withColumnRenamed("block", "chunk").drop("rows", "low", "high")
    nothing = F.array_repeat(F.lit(float("-inf")), F.size("ids"))
    open_chunks = chunks.withColumn("least", nothing)

    def round_of(taking: DataFrame, first: bool) -> DataFrame:
        name = "first" if first else "other"
        chosen = pairs(
            blocks, taking.select("chunk", "table", "least"), ["rows", "low", "high"], worth_visiting(first, count), f"pivot-{name}-pairs"
        )
        found = visits(chosen, taking, blocks.drop("rows", "low", "high"), eliminate(size, count, wanted), FOUND)
        return stored(first_rows(found, ["query_id", "copy"], wanted), f"pivot-{name}")

    nearest = round_of(open_chunks, True)
    # The score that a candidate must reach: the last wanted one so far.
    reached = (
        nearest.where(F.col("rank") == wanted)
        .groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("place", F.col("score").cast("double")))).alias("m"))
    )
    least = F.transform(
        "least", lambda x, i: F.coalesce(F.try_element_at("m", i), x)
    )
    others = round_of(open_chunks.join(reached, "chunk", "left").withColumn("least", least).drop("m"), False)
    both = nearest.drop("rank").unionByName(others.drop("rank"))
    best = without_own(first_rows(both, ["query_id", "copy"], wanted), ["query_id", "copy"], "own", k)
    return best.select("query_id", "rank", "vec_id", "score", F.col("copy").cast("int").alias("copy"))
