"""Sources mixed to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import pick, rows_of, with_row, words
from lapwise.session import stored

# Units that one task balances, and blocks whose left-over units meet in the next level.
BLOCK_UNITS = 4096
BLOCKS_MERGED = 1024

# Units held back for the landing, beside the at most two that the flight leaves open.
LANDING_UNITS = 12

UNIT = "rank long, block long, doc_id long, content long, copy long, size long, base long, pi double, source_size long, target double"


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: int) -> DataFrame:
    """``source, rank, source_size, n_docs, target`` from rows of ``source, size``.

    Sources are ranked by code point with null last and take ``weights`` in turn.  Targets
    share the total size by weight; none exceeds ``max_repeat`` times its source, and what
    is over goes to the others by weight.  That is one water level: targets are
    ``min(cap, level * weight)``, and the level is found among the sources sorted by
    ``cap / weight``.  This runs on one row for each source.
    """
    listed = ", ".join(f"{float(w)}D" for w in weights)
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs")
    )
    weighted = totals.withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    ).withColumns({
        "weight": F.expr(f"element_at(array({listed}), cast((rank - 1) % {len(weights)} as int) + 1)"),
        "cap": (F.col("source_size") * max_repeat).cast("double"),
    })
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    levels = weighted.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("weight").over(after),
    )
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    # Past the first source that fits, counting more sources as capped only lowers the level.
    return levels.withColumn("level", F.max(fits).over(everything)).select(
        "source", "rank", "source_size", "n_docs",
        F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def is_open(pi: np.ndarray) -> np.ndarray:
    """The one test of whether a unit is undecided, however small its fraction."""
    return (pi > 0) & (pi < 1)


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities towards 0 and 1 while their sum and their sum of sizes stay.

    Three open units at a time have one direction that both totals ignore; a random step
    along it, to where the first unit closes, keeps every probability in expectation.  The
    unit that ends the step is closed exactly, so every step closes one and at most two units
    stay open.
    """
    pi = pi.copy()
    window: list[int] = []
    rest = iter(np.flatnonzero(is_open(pi)).tolist())
    while True:
        window += itertools.islice(rest, 3 - len(window))
        if len(window) == 3:
            a, b, c = (float(size[i]) for i in window)
            step = np.array([c - b, a - c, b - a])
            if not step.any():
                step = np.array([1.0, -1.0, 0.0])
        elif len(window) == 2 and size[window[0]] == size[window[1]]:
            step = np.array([1.0, -1.0])
        else:
            return pi
        at = pi[window]
        with np.errstate(divide="ignore"):
            up = np.where(step > 0, (1 - at) / np.abs(step), np.where(step < 0, at / np.abs(step), np.inf))
            down = np.where(step > 0, at / np.abs(step), np.where(step < 0, (1 - at) / np.abs(step), np.inf))
        forward, back = up.min(), down.min()
        if rng.random() * (forward + back) < back:
            ends, moved = up, at + step * forward
            bound = (step > 0).astype(float)
        else:
            ends, moved = down, at - step * back
            bound = (step < 0).astype(float)
        moved = np.clip(moved, 0.0, 1.0)
        moved[ends <= ends.min()] = bound[ends <= ends.min()]
        pi[window] = moved
        window = [i for i, p in zip(window, moved) if 0.0 < p < 1.0]


def landing(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Close the last open units, a dozen or two, by the nearest of all outcomes.

    An outcome's distance is its error in size, in mean units, with a light weight on its
    error in count.  The nearest is taken, not drawn: here, and only here, probabilities of
    inclusion are not kept.
    """
    units = np.flatnonzero(is_open(pi))
    if not len(units):
        return pi
    if len(units) > LANDING_UNITS + 2:
        raise ValueError(f"{len(units)} open units are too many to land")
    outcomes = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
    error = outcomes - pi[units]
    distance = np.abs(error @ size[units]) / max(size[units].mean(), 1) + 0.05 * np.abs(error.sum(axis=1))
    out = pi.copy()
    out[units] = outcomes[distance.argmin()]
    return out


def balancer(level: int, last: bool, seed: int):
    """For `applyInArrow` on one block: flight, and landing on the last level."""

    def balance(table: pa.Table) -> pa.Table:
        table = table.sort_by(
            [(c, "ascending") for c in ("doc_id", "content", "copy")]
        )
        rank, block = table["rank"][0].as_py(), table["block"][0].as_py()
        rng = np.random.default_rng([seed, level, rank, block])
        pi, size = table["pi"].to_numpy(), table["size"].to_numpy()
        order = rng.permutation(len(pi))
        # The last level holds a few units back, so that the landing has a choice.
        held = order[:LANDING_UNITS] if last else order[:0]
        flown = order[len(held):]
        out = pi.copy()
        out[flown] = flight(pi[flown], size[flown], rng)
        if last:
            out = landing(out, size)
        return table.set_column(table.schema.get_field_index("pi"), "pi", pa.array(out))

    return balance


def cube(units: DataFrame, seed: int) -> DataFrame:
    """``units`` with ``pi`` 0 or 1; every rank's sum of ``pi`` and of sizes is kept.

    Blocks of bounded size are balanced on their own; the at most two open units of each
    meet in larger blocks, level by level, until one block a rank is left, which lands.
    """
    blocks = (units.agg(F.max("block")).first()[0] or 0) + 1
    decided = None
    level = 0
    while True:
        last = blocks == 1
        moved = stored(
            units.groupBy("rank", "block").applyInArrow(balancer(level, last, seed), UNIT),
            f"cube-{level}",
        )
        closed = moved.where("pi = 0 or pi = 1")
        decided = closed if decided is None else decided.unionByName(closed)
        if last:
            return decided
        units = moved.where("pi > 0 and pi < 1").withColumn(
            "block", F.expr(f"block div {BLOCKS_MERGED}")
        )
        blocks = -(-blocks // BLOCKS_MERGED)
        level += 1


def copies(
    sized: DataFrame, weights: Sequence[float], max_repeat: int, seed: int
) -> DataFrame:
    """From ``doc_id, source, size, content`` one row each with ``taken`` copies.

    Repeated rows (equal in all four) are numbered, so the draw does not depend on how the
    rows lie in partitions.
    """
    numbered = (
        sized.groupBy("doc_id", "source", "size", "content").agg(F.count("*").alias("n"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    )
    targets = stored(source_targets(sized, weights, max_repeat), "source-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (
        numbered.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("rate", F.least(F.round(rate, 12), F.lit(float(max_repeat))))
        .withColumn("base", F.floor("rate"))
        .withColumn("pi", F.col("rate") - F.col("base"))
        .withColumn(
            "block",
            F.pmod(
                F.xxhash64("doc_id", "content", "copy"),
                F.ceil(F.col("n_docs") / BLOCK_UNITS),
            ),
        )
        .select(*[c.split()[0] for c in UNIT.split(", ")])
    )
    return cube(units, seed)


def _size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_repeat: int = 3,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every row.

    A document's size is its words (null text: 0).  A source whose target is ``r`` times its
    size takes every document ``floor(r)`` times and once more with the probability that is
    left; the cube method draws these so that each source's documents and words come to
    their targets but for the landing of a dozen units, whose nearest outcome is taken instead of
    drawn.  A null source is a source; one
    without words has target 0 and takes nothing.  The draw depends on the seed and on the
    rows alone.  An empty table gives no rows.
    """
    sized = stored(
        pick(docs, id_col, text_col, source_col).select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            _size(F.col(text_col)).alias("size"),
            F.xxhash64(text_col).alias("content"),
        ),
        "mix-sizes",
    )
    drawn = copies(sized, weights, max_repeat, seed)
    times = F.col("base") + F.col("pi").cast("long")
    return drawn.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * times).alias("taken"), times.alias("copies"),
    )


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    max_repeat: int = 3,
    seed: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The rows of ``docs`` as often as `mix` takes them, with all their columns."""
    packed = with_row(docs, id_col, text_col, source_col).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        _size(F.col(text_col)).alias("size"),
        F.xxhash64("row").alias("content"),
        "row",
    )
    sized = stored(packed.drop("row"), "mix-sizes")
    taken = copies(sized, weights, max_repeat, seed).groupBy("doc_id", "content").agg(
        F.sum(F.col("base") + F.col("pi").cast("long")).alias("times")
    )
    rows = packed.select("doc_id", "content", "row").dropDuplicates(["doc_id", "content"])
    joined = rows.alias("r").join(
        taken.alias("t"),
        F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r.content") == F.col("t.content")),
    ).where("times > 0")
    return rows_of(
        joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("time")),
        docs,
    )
