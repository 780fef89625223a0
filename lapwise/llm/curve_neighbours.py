"""Nearest neighbours by inner product along several shifted Hilbert curves."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import pick, running_totals
from lapwise.session import passing, release, stored

# Curves, and the dimensions and bits of the projected grid each runs through.
CURVES = 16
GRID_DIMENSIONS = 8
GRID_BITS = 7

# Index rows of a block, and the share of a curve's blocks that a query looks at around its own
# place: in 64 dimensions, and how it grows with them.
BLOCK_ROWS = 1024
REACH = 0.1
REACH_GROWTH = 0.18

# Index rows whose norms lie within a factor of two to this power share a scale and curves.  The
# borders are odd powers of two, well away from 1, where norms like to gather.
BAND_BITS = 2

# Rows that the scale of queries and the grid of each curve are fitted on, for each group of bands.
FIT_ROWS = 512

# Rows that are placed on curves at one time; where there are more, one curve goes after the other.
PASS_ROWS = 1 << 18

# Bytes of a span's vectors, products that a task holds, and queries of a span that is not shared
# out, unless more than `UNEVEN` times as many meet a span on average.
SPAN_BYTES = 32 * 1024**2
PRODUCTS = 1 << 22
CHUNK_QUERIES = 4096
UNEVEN = 4

KEYED = "curve int, curve_key long, mark long, counted long"
ASKED = "curve int, span int, n long"
SPANNED = "curve int, span int, chunk int, asks boolean, block int, ids array<long>, embedding array<double>"
FOUND = "query_id long, copy long, score double, head long, mark long, own boolean, ids array<long>"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid cells (one row each) along the Hilbert curve.

    The cell's coordinates are turned into the curve's transposed index by undoing, from
    the highest bit down, the exchange and reflection that the curve applied, and then by
    Gray decoding; their bits are interleaved.
    """
    axes = [column.copy() for column in cells.astype(np.int64).T]
    first = axes[0]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in axes:
            set_here = (axis & bit) != 0
            swapped = np.where(set_here, 0, (first ^ axis) & low)
            first ^= np.where(set_here, low, 0)
            first ^= swapped
            if axis is not first:
                axis ^= swapped
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    flips = np.zeros_like(first)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(axes[-1] & (1 << level), (1 << level) - 1, 0)
    key = np.zeros_like(first)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flips) >> level) & 1)
    return key


def projections(size: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each curve an orthonormal projection and a shift of its grid."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(CURVES):
        matrix = rng.normal(size=(size, min(GRID_DIMENSIONS, size)))
        out.append((np.linalg.qr(matrix)[0], rng.random(min(GRID_DIMENSIONS, size))))
    return out


def band_groups(counts: dict[int, int], block_rows: int) -> list[tuple[list[int], int]]:
    """Norm bands that share their curves, and the number of these.

    A band of more than a block has curves of its own; smaller ones fill blocks together,
    and in one block the search is exact on one curve.
    """
    groups = [([band], CURVES) for band in sorted(counts) if counts[band] > block_rows]
    left = 0
    for band in sorted(b for b in counts if counts[b] <= block_rows):
        if counts[band] > left:
            groups.append(([], 1))
            left = block_rows
        groups[-1][0].append(band)
        left -= counts[band]
    return groups


def scaled(rows: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Index rows over the end of their norm band, with one more component that makes them unit vectors."""
    inside = np.ldexp(rows, -(BAND_BITS * band + BAND_BITS // 2)[:, None])
    rest = np.sqrt(np.maximum(0, 1 - (inside * inside).sum(axis=1)))
    return np.hstack([inside, rest[:, None]])


def fitted(rows: np.ndarray, band: np.ndarray, seed: int) -> tuple[float, list[tuple[np.ndarray, np.ndarray]]]:
    """From a sample of a group: the norm queries get, and each curve's grid (begin and width).

    The order of a band by inner product is that by distance from a query of any length; with
    the length of the group's longer rows, a query lies among its neighbours on the curves.
    """
    unit = scaled(rows, band)
    length = float(np.quantile(np.sqrt((unit[:, :-1] ** 2).sum(axis=1)), 0.9))
    grids = []
    for matrix, _ in projections(rows.shape[1] + 1, seed):
        low, high = np.quantile(unit @ matrix, [0.005, 0.995], axis=0)
        grids.append((low, np.maximum(high - low, 1e-9)))
    return min(length, 1.0), grids


def doubles(embedding: pa.Array, size: int) -> np.ndarray:
    return embedding.flatten().to_numpy().astype(np.float64).reshape(-1, size)


def marks(rows: np.ndarray) -> np.ndarray:
    """A hash of each vector."""
    factors = np.random.default_rng(7).integers(1, 1 << 63, rows.shape[1], np.uint64) | np.uint64(1)
    return ((rows + 0.0).view(np.uint64) * factors).sum(axis=1).view(np.int64)


@dataclass(frozen=True)
class Curves:
    """Where rows lie on some of the curves: those of ``numbers``, counted over all groups."""

    size: int
    groups: list[tuple[list[int], int]]
    fits: list
    seed: int
    numbers: frozenset[int]

    def keys(self, rows: np.ndarray, asks: np.ndarray, band: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each curve its number, the rows on it and their keys.

        Index rows are on the curves of their own group; a query is on those of all groups.
        """
        curves = projections(self.size + 1, self.seed)
        unit = rows / np.abs(rows).max(axis=1)[:, None]
        unit /= np.sqrt((unit * unit).sum(axis=1))[:, None]
        index = scaled(rows, np.where(asks, 0, band))
        first = 0
        for (bands, own), (length, grids) in zip(self.groups, self.fits):
            mine = [c for c in range(own) if first + c in self.numbers]
            taking = np.flatnonzero(asks | np.isin(band, bands)) if mine else []
            if len(taking):
                query = np.hstack([
                    length * unit[taking], np.full((len(taking), 1), np.sqrt(max(0.0, 1 - length * length)))
                ])
                point = np.where(asks[taking][:, None], query, index[taking])
            for c in mine if len(taking) else ():
                (matrix, shift), (low, width) = curves[c], grids[c]
                # A shifted grid of twice the width of the sampled rows' projection.
                cell = ((point @ matrix - low) / width / 2 + shift / 2) * (1 << GRID_BITS)
                cell = np.clip(cell, 0, (1 << GRID_BITS) - 1)
                yield first + c, taking, hilbert_keys(cell, GRID_BITS)
            first += own


def keyed(curves: Curves):
    """For `mapInArrow` over classes: a row for each class and curve, without the vector."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = doubles(batch.column(1), curves.size)
                mark, band = marks(rows), batch.column(3).to_numpy()
                for number, taking, key in curves.keys(rows, np.zeros(len(rows), bool), band):
                    yield record(KEYED, [np.full(len(taking), number, np.int32), key, mark[taking], np.ones(len(taking), np.int64)])

    return place


def record(columns: str, arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays],
        names=[c.split()[0] for c in columns.split(", ")],
    )


@dataclass(frozen=True)
class Blocks:
    """One curve's blocks: where each begins, how many a query meets, and how many are a span."""

    begins: np.ndarray
    width: int
    span: int
    hot: dict[int, int] = field(default_factory=dict)

    def own(self, key: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The block of each place: the last one that begins there or before."""
        places = np.empty(len(key), self.begins.dtype)
        places["key"], places["mark"] = key, mark
        low = np.searchsorted(self.begins["key"], key, "left")
        high = np.searchsorted(self.begins["key"], key, "right")
        tied = np.flatnonzero(low < high)
        high[tied] = np.searchsorted(self.begins, places[tied], "right")
        return np.maximum(high - 1, 0)

    def spans(self, own: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's first block (a class has its own only), and rows with the spans they go to."""
        met = np.maximum(0, np.minimum(own - self.width // 2, len(self.begins) - self.width))
        begin = np.where(asks, met, own)
        first = begin // self.span
        count = np.where(asks, (begin + self.width - 1) // self.span - first + 1, 1)
        who = np.repeat(np.arange(len(own)), count)
        return begin, who, first[who] + np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)


def asked_spans(curves: Curves, blocks: dict[int, Blocks]):
    """For `mapInArrow` over queries: how many of a batch meet each span."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, asks = doubles(batch.column(1), curves.size), np.ones(batch.num_rows, bool)
                mark = marks(rows)
                for number, taking, key in curves.keys(rows, asks, batch.column(3).to_numpy()):
                    curve = blocks[number]
                    span, n = np.unique(curve.spans(curve.own(key, mark[taking]), asks[taking])[2], return_counts=True)
                    yield record(ASKED, [np.full(len(span), number, np.int32), span.astype(np.int32), n.astype(np.int64)])

    return count


def spanned(curves: Curves, blocks: dict[int, Blocks]):
    """For `mapInArrow` over classes and queries: classes go to the span of their block, queries to all they meet.

    A span that very many queries meet is there several times, each for a share of them.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = doubles(batch.column(1), curves.size)
            mark, asks, band = marks(rows), batch.column(2).to_numpy() == 0, batch.column(3).to_numpy()
            for number, taking, key in curves.keys(rows, asks, band):
                curve, asking = blocks[number], asks[taking]
                begin, who, span = curve.spans(curve.own(key, mark[taking]), asking)
                chunk = np.zeros(len(who), np.int32)
                for hot, chunks in curve.hot.items():
                    here = np.flatnonzero(span == hot)
                    queries, index = here[asking[who[here]]], who[here[~asking[who[here]]]]
                    asked = batch.column(0).take(pa.array(taking[who[queries]])).flatten().to_numpy().reshape(-1, 2)
                    mixed = (asked[:, 0] + (asked[:, 1] << 40)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    chunk[queries] = (mixed >> np.uint64(33)) % np.uint64(chunks)
                    who = np.append(who, np.repeat(index, chunks - 1))
                    span = np.append(span, np.full(len(index) * (chunks - 1), hot))
                    chunk = np.append(chunk, np.tile(np.arange(1, chunks, dtype=np.int32), len(index)))
                part = batch.take(pa.array(taking[who]))
                yield record(SPANNED, [
                    np.full(len(who), number, np.int32), span.astype(np.int32), chunk, asking[who],
                    begin[who].astype(np.int32), part.column(0), part.column(1),
                ])

    return place


class Span:
    """The index rows of one span, in the order of their blocks."""

    def __init__(self, key: tuple[int, int, int], size: int, width: int) -> None:
        self.key, self.size, self.width = key, size, width
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.rows: np.ndarray | None = None

    def add(self, run: pa.RecordBatch) -> None:
        self.parts.append((run.column("block").to_numpy(), doubles(run.column("embedding"), self.size), run.column("ids")))

    def best(self, queries: pa.RecordBatch, wanted: int) -> Iterator[pa.RecordBatch]:
        """The best rows of the blocks that each query meets.

        Candidates are chosen by one matrix product and scored again component by component, so
        a pair has the same score wherever it is met.
        """
        if self.rows is None:
            self.block, self.rows = np.concatenate([p[0] for p in self.parts]), np.concatenate([p[1] for p in self.parts])
            self.ids = pa.concat_arrays([p[2] for p in self.parts])
            self.heads = pa.compute.list_element(self.ids, 0).to_numpy()
            self.marks, self.parts = marks(self.rows), []
        begin = queries.column("block").to_numpy()
        low, high = np.searchsorted(self.block, begin), np.searchsorted(self.block, begin + self.width)
        asked = doubles(queries.column("embedding"), self.size)
        query = queries.column("ids").flatten().to_numpy().reshape(-1, 2)
        step = max(1, PRODUCTS // len(self.rows))
        for at in range(0, len(asked), step):
            yield self._best(asked[at : at + step], query[at : at + step], low[at : at + step], high[at : at + step], wanted)

    def _best(self, asked: np.ndarray, query: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: int) -> pa.RecordBatch:
        start = low.min()
        with np.errstate(all="ignore"):
            # Products beyond the range of doubles are infinite, or without a value and last.
            products = np.nan_to_num(
                asked @ self.rows[start : high.max()].T, nan=-np.inf, posinf=np.inf, neginf=-np.inf
            )
        picked, who, scores = [np.zeros(0, int)], [np.zeros(0, int)], [np.zeros(0)]
        for q, row in enumerate(products):
            rough = row[low[q] - start : high[q] - start]
            if not len(rough):
                continue
            count = min(wanted, len(rough))
            floor = np.partition(rough, len(rough) - count)[len(rough) - count]
            slack = 1e-9 * max(1, abs(floor)) if np.isfinite(floor) else 0
            near = low[q] + np.flatnonzero(rough >= floor - slack)
            with np.errstate(all="ignore"):
                score = (self.rows[near] * asked[q]).sum(axis=1)
            order = np.lexsort((self.marks[near], self.heads[near], -score))[:wanted]
            picked.append(near[order])
            scores.append(score[order])
            who.append(np.full(len(order), q))
        picked, who = np.concatenate(picked), np.concatenate(who)
        own = (self.rows[picked] == asked[who]).all(axis=1)
        return record(FOUND, [
            query[who, 0], query[who, 1], np.concatenate(scores), self.heads[picked], self.marks[picked], own,
            self.ids.take(pa.array(picked)),
        ])


def nearest(wanted: int, size: int, widths: dict[int, int]):
    """For `mapInArrow` over rows sorted by span, classes first: the best rows of a span for each of its queries.

    A span is held, queries pass by.
    """
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("curve", "span", "chunk", "asks")])
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                *key, asks = keys[:, start].tolist()
                run = batch.slice(start, end - start)
                if not asks:
                    if held is None or held.key != tuple(key):
                        held = Span(tuple(key), size, widths[key[0]])
                    held.add(run)
                elif held is not None and held.key == tuple(key):
                    yield from held.best(run, wanted)

    return best


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, embedding`` of the rows that take part; floats stay floats, others become doubles."""
    rows = pick(vectors, id_col, vector_col)
    kind = dict(rows.dtypes)[vector_col]
    rows = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast(kind if kind == "array<float>" else "array<double>").alias("embedding"),
    )
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    ).where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))


def passes(totals: list[int]) -> list[list[int]]:
    """The curves that are searched at one time, of which each takes ``totals`` rows."""
    out, taken = [], PASS_ROWS
    for number, total in enumerate(totals):
        if taken + total > PASS_ROWS:
            out.append([])
            taken = 0
        out[-1].append(number)
        taken += total
    return out


def blocks_of(classes: DataFrame, curves: Curves, totals: dict[int, int], reach: float) -> dict[int, Blocks]:
    """The blocks of each curve, from the place of every `BLOCK_ROWS`-th row along it.

    Rows are ordered without their vectors; the driver gets one row for each block.
    """
    placed = classes.mapInArrow(keyed(curves), KEYED)
    ordered = running_totals(placed, ["curve", "curve_key", "mark"], {"before": "counted"}, "curve-rows")
    bases, base = [], 0
    for number in sorted(totals):
        bases.append((number, base))
        base += totals[number]
    begins = (
        ordered.join(F.broadcast(classes.sparkSession.createDataFrame(bases, "curve int, base long")), "curve")
        .where((F.col("before") - F.col("base")) % BLOCK_ROWS == 0).select("curve", "curve_key", "mark").collect()
    )
    at: dict[int, list] = {}
    for r in begins:
        at.setdefault(r["curve"], []).append((r["curve_key"], r["mark"]))
    most, out = max(1, SPAN_BYTES // (8 * curves.size * BLOCK_ROWS)), {}
    for number, places in at.items():
        width = min(len(places), int(np.ceil(reach * len(places))) + 1)
        begin = np.array(sorted(places), dtype=[("key", np.int64), ("mark", np.int64)])
        out[number] = Blocks(begin, width, min(most, -(-width // 2)))
    return out


def met(
    classes: DataFrame, asking: DataFrame, curves: Curves, totals: dict[int, int], reach: float, k: int
) -> DataFrame:
    """The best rows of each span for the queries that meet blocks of it, on some of the curves.

    A span of neighbouring blocks and the queries that meet any of them are sorted together;
    a task holds the span's vectors while the queries pass by.
    """
    blocks = blocks_of(classes, curves, totals, reach)
    asked = asking.mapInArrow(asked_spans(curves, blocks), ASKED).groupBy("curve", "span").agg(F.sum("n").alias("n"))
    spans = {n: -(-len(b.begins) // b.span) for n, b in blocks.items()}
    partitions = sum(spans.values())
    # One row for each span.
    counts = asked.collect()
    share = max(CHUNK_QUERIES, UNEVEN * sum(r["n"] for r in counts) // partitions)
    for r in counts:
        if r["n"] > share:
            blocks[r["curve"]].hot[r["span"]] = -(-r["n"] // share)
            partitions += -(-r["n"] // share) - 1
    kind = SPANNED.replace("array<double>", dict(classes.dtypes)["embedding"])
    keys = ["curve", "span", "chunk"]
    return (
        classes.unionByName(asking).mapInArrow(spanned(curves, blocks), kind)
        .repartition(partitions, *keys).sortWithinPartitions(*keys, "asks", "block")
        .mapInArrow(nearest(k + 1, curves.size, {n: b.width for n, b in blocks.items()}), FOUND)
    )


def closest(found: DataFrame, k: int) -> DataFrame:
    """The ``k + 1`` best classes found for each query; one that was met on several curves counts once."""
    asker = ["query_id", "copy"]
    place = F.dense_rank().over(Window.partitionBy(*asker).orderBy(F.desc("score"), "head", "mark"))
    return (
        found.withColumn("place", place).where(F.col("place") <= k + 1)
        .dropDuplicates([*asker, "head", "mark"]).drop("place")
    )


def search(
    vectors: DataFrame,
    query_step: int = 20,
    k: int = 20,
    reach: float | None = None,
    seed: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score, copy``: the ``k`` best rows found for each query.

    Queries are the rows whose id is divisible by ``query_step``; every row takes part as a
    candidate but the query's own.  Equal vectors are one index row with their ``k + 1``
    smallest ids, so a crowd of copies fills no window.  On each curve a query meets the
    blocks around its place, a share ``reach`` of them; in vectors without any structure
    recall follows this share, and needs more of it in more dimensions, which is why the default
    is one and grows.  Rows of like norms have curves of their own, whose grids are fitted on a
    bounded sample of them, so a few long vectors do not push the others together.  Scores are
    inner products in double precision of the vectors as given; ties go to the smaller id.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part,
    nor do null ids and vectors of another length than the most frequent one (of equally
    frequent lengths, the greater).  Rows of one id are rows of their own: each asks for itself,
    told apart by ``copy`` (from 1, in the order of their vectors), only itself is not its
    candidate, and each is a candidate of others.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double, copy int"
    rows = usable(vectors, id_col, vector_col)
    sizes = rows.groupBy(F.size("embedding").alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if first is None:
        return spark.createDataFrame([], empty)
    size = first["size"]
    if reach is None:
        reach = REACH * max(1.0, size / 64) ** REACH_GROWTH
    rows = rows.where(F.size("embedding") == size)
    # The norm's exponent, taken without leaving the range of doubles.
    wide = F.col("embedding").cast("array<double>")
    top = F.array_max(F.transform(wide, F.abs))
    parts = F.aggregate(wide, F.lit(0.0), lambda s, x: s + (x / top) * (x / top))
    exponent = F.log2(top) + F.log2(parts) / 2
    band = F.floor((exponent + BAND_BITS // 2) / BAND_BITS).cast("int").alias("band")
    counts = {r["band"]: r["count"] for r in rows.groupBy(band).count().collect()}
    groups = band_groups(counts, BLOCK_ROWS)
    smallest = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    copy = F.row_number().over(Window.partitionBy("vec_id").orderBy("embedding")).cast("long")
    with passing(spark):
        classes = stored(
            rows.withColumn("n", smallest).where(F.col("n") <= k + 1)
            .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select("ids", "embedding", F.lit(1).cast("long").alias("counted"), band),
            "curve-classes",
        )
        release(spark)
        # One row for each norm band, of which doubles have some hundreds.
        sizes = dict(classes.groupBy("band").count().collect())
        group_of = spark.createDataFrame(
            [(b, g) for g, (bands, _) in enumerate(groups) for b in bands], "band int, part int"
        )
        by_hash = Window.partitionBy("part").orderBy(F.xxhash64(wide), "embedding")
        sampled = (
            classes.join(F.broadcast(group_of), "band").withColumn("n", F.row_number().over(by_hash))
            .where(F.col("n") <= FIT_ROWS).select("part", "band", wide.alias("embedding")).collect()
        )
        fits = []
        for g in range(len(groups)):
            mine = [r for r in sampled if r["part"] == g]
            fits.append(fitted(np.array([r["embedding"] for r in mine]), np.array([r["band"] for r in mine]), seed))
        asking = stored(
            rows.where(F.col("vec_id") % query_step == 0).withColumn("copy", copy).select(
                F.array("vec_id", "copy").alias("ids"), "embedding", F.lit(0).cast("long").alias("counted"),
                F.lit(0).alias("band"),
            ),
            "curve-queries",
        )
        totals = [sum(sizes[b] for b in bands) for bands, own in groups for _ in range(own)]
        best, stays = None, []
        for numbers in passes(totals):
            with passing(spark) as paths:
                paths += stays
                curves = Curves(size, groups, fits, seed, frozenset(numbers))
                found = met(classes, asking, curves, {n: totals[n] for n in numbers}, reach, k)
                better = stored(closest(found if best is None else found.unionByName(best), k), "curve-best")
                # What has been found so far goes when the next pass has taken it along.
                best, stays = better, [paths.pop()]
            release(spark)
    asker = ["query_id", "copy"]
    others = F.when(
        F.col("own"), F.expr("filter(ids, (x, i) -> i + 1 <> array_position(ids, query_id))")
    ).otherwise(F.col("ids"))
    rank = F.row_number().over(Window.partitionBy(*asker).orderBy(F.desc("score"), "vec_id"))
    return (
        best.select(*asker, "score", F.explode(others).alias("vec_id"))
        .withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score", F.col("copy").cast("int").alias("copy"))
    )
