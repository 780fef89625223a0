"""Hard negatives from candidate lists that clusters of anchors share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.llm.vector_blocks import (
    asked, block_rows, classes, first_classes, first_rows, numbers, packed, pairs, products, sample,
    visits, whole_vectors, without_own,
)
from lapwise.session import stored

# Directions that rows are ordered by, anchors of a cluster, and candidates of a list's first step.
DIRECTIONS = 64
CLUSTER_ANCHORS = 256
STEP = 128

# Rows of a list that are walked before anything is ruled out: a block, or several small ones.
HOME_ROWS = 2048

# Angles and products are widened by these, far above the rounding of doubles.
ANGLE_SLACK = 1e-6
SLACK = 1e-9

FOUND = (
    "query_id long, copy long, chunk long, place int, slot int, own long, score long, vec_id long"
)
ASK = "array<struct<place:int,slot:int,cap:bigint,least:bigint>>"


def units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay) and the lengths."""
    rows = rows.astype(np.float64)
    norms = np.sqrt((rows * rows).sum(1))
    return rows / np.where(norms > 0, norms, 1)[:, None], norms


def angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1, 1))


def middle(unit: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, float]:
    """The mean direction and the widest angle from it; zero rows have no direction."""
    unit = unit[norms > 0]
    mean = unit.sum(0)
    length = np.linalg.norm(mean)
    if length < 1e-9:
        mean = unit[0] if len(unit) else np.eye(unit.shape[1])[0]
        length = np.linalg.norm(mean)
    centre = mean / length
    return centre, float(angles(unit, centre).max(initial=0.0))


def directions(rows: np.ndarray, count: int = DIRECTIONS, rounds: int = 6) -> np.ndarray:
    """Unit centres of a bounded sample, by spherical k-means."""
    unit, norms = units(rows)
    unit = unit[norms > 0]
    if not len(unit):
        return np.eye(rows.shape[1])[:1]
    centres = unit[:count].copy()
    for _ in range(rounds):
        own = (unit @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = middle(unit[own == c], np.ones((own == c).sum()))[0]
    return centres


def widest(top, apart):
    """The greatest product per unit of the anchor's length at an angle of at least ``apart``."""
    return top * np.maximum(np.cos(np.minimum(np.maximum(apart - ANGLE_SLACK, 0), np.pi)), 0)


def floors_of(asks: pa.Array, count: int) -> np.ndarray:
    """For each member the smallest score that still matters; infinite where nothing is asked."""
    out = np.full(count, np.inf)
    if len(asks):
        np.minimum.at(out, asks.field("place").to_numpy(), asks.field("least").to_numpy().astype(float))
    return out


def worth_visiting(size: int, first: bool):
    """For `pairs`: the first blocks of the cluster's list, or the others it may have to walk."""

    def compare(summaries: pa.Array, chunk: dict):
        ids = summaries.field("block").to_numpy()
        centres = summaries.field("centre").flatten().to_numpy().reshape(-1, size)
        reach = summaries.field("radius").to_numpy() + chunk["radius"].as_py()
        apart = angles(centres, chunk["centre"].values.to_numpy()) - reach - ANGLE_SLACK
        tops = summaries.field("top").to_numpy()
        bounds = widest(tops, apart)
        ranked = np.lexsort((ids, -bounds))
        sizes = summaries.field("rows").to_numpy()[ranked]
        home = np.zeros(len(ids), bool)
        home[ranked] = np.cumsum(sizes) - sizes < HOME_ROWS
        lengths = chunk["lengths"].values.to_numpy()
        floor = floors_of(chunk["asks"].values, len(lengths))
        for b in range(len(ids)):
            if first:
                members = np.isfinite(floor) & home[b]
            else:
                most = lengths * bounds[b] + SLACK * (lengths * tops[b] + 1)
                members = (most >= floor) & ~home[b]
            if members.any():
                yield int(ids[b]), np.flatnonzero(members).astype(np.int32)

    return compare


def walk(size: int, same: bool, wanted: int):
    """For `visits`: a cluster's members walk one list of a block's rows, sorted once.

    The list falls by the angular bound that holds for every member.  A member stops when its
    length times the next bound is below the last score each of its asks still needs.
    """

    def visit(block: dict, chunk: dict, places: np.ndarray):
        rows = numbers(block["x"], size)
        unit, norms = units(rows)
        apart = angles(unit, chunk["centre"].values.to_numpy()) - chunk["radius"].as_py() - ANGLE_SLACK
        bounds = widest(norms, apart)
        order = np.argsort(-bounds, kind="stable")
        ends = bounds[order]
        labels = block["labels"].values.to_numpy()
        longest = norms.max(initial=0)

        mine = numbers(chunk["x"], size)
        lengths = chunk["lengths"].values.to_numpy()
        own_label = chunk["labels"].values.to_numpy()
        names = chunk["ids"].values.flatten().to_numpy().reshape(-1, 2)
        asks: dict[int, list[list]] = {}
        listed = chunk["asks"].values
        for place, slot, cap, least in zip(*[listed.field(f).to_numpy() for f in ("place", "slot", "cap", "least")]):
            # Slot, largest and smallest score, scores and places found so far.
            asks.setdefault(int(place), []).append([int(slot), cap, int(least), np.zeros(0, np.int64), np.zeros(0, np.int64)])

        def open_at(places: np.ndarray, at: int) -> np.ndarray:
            if at >= len(order):
                return places[:0]
            most = lengths[places] * ends[at] + SLACK * (lengths[places] * longest + 1)
            floor = np.array([min((a[2] for a in asks.get(int(p), [])), default=np.inf) for p in places])
            return places[most >= floor]

        members, at, step = open_at(places, 0), 0, STEP
        while len(members):
            part = order[at : at + step]
            scores = products(mine[members], rows[part])
            for m, p in enumerate(members):
                fitting = (labels[part] == own_label[p]) == same
                for ask in asks[int(p)]:
                    good = np.flatnonzero(fitting & (scores[m] <= ask[1]) & (scores[m] >= ask[2]))
                    if not len(good):
                        continue
                    ask[3] = np.append(ask[3], scores[m][good])
                    ask[4] = np.append(ask[4], part[good])
                    if len(ask[3]) >= wanted:
                        least = int(np.partition(ask[3], len(ask[3]) - wanted)[len(ask[3]) - wanted])
                        ask[2] = max(ask[2], least)
                        kept = ask[3] >= ask[2]
                        ask[3], ask[4] = ask[3][kept], ask[4][kept]
            at, step = at + step, 2 * step
            members = open_at(members, at)

        out = []
        for p in places:
            own = int(products(mine[p : p + 1], mine[p : p + 1])[0, 0])
            for slot, _, _, score, place in asks.get(int(p), []):
                found = first_classes(score, block["ids"], place, wanted) if len(score) else []
                out += [(*names[p].tolist(), int(p), slot, own, s, i) for s, i in found]
        if out:
            query, copy, place, slot, own, score, ids = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query), pa.array(copy), pa.array([chunk["chunk"].as_py()] * len(out)),
                 pa.array(place, pa.int32()), pa.array(slot, pa.int32()), pa.array(own), pa.array(score), pa.array(ids)],
                names=[c.split()[0] for c in FOUND.split(", ")],
            )

    return visit


def mine(
    vectors: DataFrame,
    anchor_step: int = 100,
    positives: int = 5,
    negatives: int = 10,
    band: tuple[int, int] = (30, 90),
    scale: int = 256,
    relabel: Callable[[Column, Column], Column] | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score, copy, positive_rank``.

    Entries become ``floor(scale * entry)``; a row's score is its integer inner product with the
    anchor; higher scores come first, ties by smaller id.  Anchors are the rows whose id is
    divisible by ``anchor_step``, an anchor's positives its first ``positives`` other rows of the same
    label.  For each positive the first ``negatives`` rows of another label are returned whose
    score lies within ``band`` percent of the positive's; none for a negative positive score.
    ``relabel(id, label)`` may change the labels first.

    Anchors near each other form a cluster with a centre and a widest angle.  A candidate's angle to
    the centre, less the widest, bounds its score with every member; candidates are sorted by that
    bound once for the cluster, block by block, and each member walks the list until the
    bound certifies that nothing left can be among its rows.  The list's first blocks are walked
    first; what they yield rules out later blocks before they are read.

    Rows with a null label, a null or empty vector or a null or non-finite component take no part,
    nor do null ids, vectors of another length than the most frequent one (of equally
    frequent lengths, the greater) and components so large that a score could leave a long.
    Zero vectors score 0.  Rows of one id are rows of their own: each is an anchor, told apart by
    ``copy`` (from 1, in the order of vectors and labels), and copies of a vector are
    candidates each; ``positive_rank`` tells positives of one id apart.  An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    result = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
        " negative_score long, copy int, positive_rank int"
    )
    rows, size = whole_vectors(vectors, scale, id_col, vector_col, label_col)
    if not size:
        return spark.createDataFrame([], result)
    label = F.col(label_col) if relabel is None else relabel(F.col("vec_id"), F.col(label_col))
    rows = rows.select("vec_id", "x", label.cast("long").alias("label")).where("label is not null")
    keep = max(positives + 1, negatives)
    index = stored(classes(rows, keep, "label"), "negative-classes")
    centres = directions(sample(index, size))

    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = units(x)[0] @ centres.T
        return cosine.argmax(1), -cosine.max(1)

    def describe(x: np.ndarray, part: pa.Table) -> list:
        unit, norms = units(x)
        centre, radius = middle(unit, norms)
        return [len(x), part["label"].to_pylist(), centre.tolist(), radius, norms.tolist(), float(norms.max())]

    extra = "rows bigint, labels array<bigint>, centre array<double>, radius double, lengths array<double>, top double"
    blocks = packed(index, place, describe, size, block_rows(size), "negative-blocks", extra)
    clusters = packed(
        asked(rows, anchor_step, "label"), place, describe, size, min(CLUSTER_ANCHORS, block_rows(size)),
        "negative-clusters", extra,
    ).withColumnRenamed("block", "chunk").drop("rows", "top")
    blocks = blocks.drop("lengths")

    def walked(asks: DataFrame, same: bool, wanted: int, first: bool, label: str) -> DataFrame:
        gathered = asks.groupBy("chunk").agg(
            F.collect_list(F.struct("place", "slot", "cap", "least")).cast(ASK).alias("asks")
        )
        asking = clusters.join(gathered, "chunk")
        chosen = pairs(
            blocks, asking.select("chunk", "centre", "radius", "lengths", "asks"), ["rows", "centre", "radius", "top"],
            worth_visiting(size, first), f"{label}-pairs",
        )
        found = visits(chosen, asking, blocks.drop("rows", "centre", "radius", "top"), walk(size, same, wanted), FOUND)
        return stored(first_rows(found, ["query_id", "copy", "slot"], wanted), label)

    def both(asks: DataFrame, same: bool, wanted: int, label: str) -> DataFrame:
        nearest = walked(asks, same, wanted, True, f"{label}-first")
        reached = nearest.where(F.col("rank") == wanted).select(
            "chunk", "place", "slot", F.col("score").alias("reached")
        )
        rest = asks.join(reached, ["chunk", "place", "slot"], "left").withColumn("least", F.greatest("least", "reached"))
        others = walked(rest, same, wanted, False, f"{label}-rest")
        return first_rows(nearest.drop("rank").unionByName(others.drop("rank")), ["query_id", "copy", "slot"], wanted)

    every = clusters.select("chunk", F.posexplode("ids").alias("place", "member")).select(
        "chunk", "place", F.lit(0).alias("slot"),
        F.lit((1 << 63) - 1).cast("long").alias("cap"), F.expr("-9223372036854775807L").alias("least"),
    )
    chosen = stored(
        without_own(both(every, True, positives + 1, "positives"), ["query_id", "copy"], "own", positives),
        "positives",
    )
    share = F.col("score").cast("decimal(20,0)")
    asks = chosen.select(
        "chunk", "place", F.col("rank").alias("slot"),
        F.floor(share * band[1] / 100).cast("long").alias("cap"),
        F.ceil(share * band[0] / 100).cast("long").alias("least"),
    ).where("cap >= least")
    ranked = both(asks, False, negatives, "negatives").select(
        "query_id", "copy", "slot", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"), F.col("rank").cast("int").alias("rank"),
    )
    given = chosen.select(
        "query_id", "copy", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return ranked.join(given, ["query_id", "copy", "slot"]).select(
        F.col("query_id").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score",
        "negative_score", F.col("copy").cast("int").alias("copy"), F.col("slot").alias("positive_rank"),
    )
