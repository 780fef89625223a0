"""Documents that share most of their word n-grams, by blocked products of the incidence matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise.llm.common import SEPARATORS, marked, packed_text, pick, rows_of, unpacked, with_row
from lapwise.llm.graphs import components
from lapwise.session import stored

WORDS = 5
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80

# A block of the incidence matrix: rows, non-zero entries, and columns multiplied at once.
BLOCK_ROWS = 1024
BLOCK_ENTRIES = 2_000_000
BLOCK_COLUMNS = 4096

# Bits of a gram's hash that the sieve compares; a false match there only keeps a set longer.
SIEVE_BITS = np.int64((1 << 48) - 1)

SKETCH = "doc_id long, content long, key long, n long, need long, prefix array<long>"
PACKED = "id long, none boolean, content long, packed binary"
SETS = "key long, grams array<long>"
PRODUCT = "key long, hub long, links long"


def shingles(text: bytes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word 5-grams; a shorter text is one n-gram.

    ASCII letters are lower-cased; ASCII white space separates words.
    """
    from xxhash import xxh3_64_intdigest

    words = text.lower().split()
    grams = {
        xxh3_64_intdigest(b" ".join(words[i : i + WORDS]))
        for i in range(max(1, len(words) - WORDS + 1) if words else 0)
    }
    out = np.fromiter(grams, np.uint64, len(grams)).view(np.int64)
    out.sort()
    return out


def least_overlap(n: int) -> int:
    """Grams that a set of ``n`` has in common with any set it links with, at least."""
    return -(-n * PERCENT // 100)


def set_key(grams: np.ndarray) -> int | None:
    from xxhash import xxh3_64_intdigest

    if not len(grams):
        return None
    return int(np.uint64(xxh3_64_intdigest(grams.tobytes())).view(np.int64))


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: size, key and the first grams in hash order of each document.

    Of two linked sets, each has its first ``k`` common grams among its first
    ``n - least_overlap(n) + k`` ones.  With ``k`` a twentieth of the size, a set shares at
    least ``need`` grams of its prefix with the prefix of any set it links with.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            sets = [shingles((t.as_py() or "").encode()) for t in part.column(1)]
            cut = [s[: len(s) - least_overlap(len(s)) + max(1, len(s) // 20)] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).cast(pa.int64()),
                    part.column(2),
                    pa.array([set_key(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([max(1, least_overlap(len(s)) // 20) for s in sets], pa.int64()),
                    ragged([c & SIEVE_BITS for c in cut]),
                ],
                names=[c.split()[0] for c in SKETCH.split(", ")],
            )


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over ``id, none, content, text``: the texts compressed, to travel."""
    for batch in batches:
        texts = [packed_text(t.as_py()) for t in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(texts, pa.binary())], names=["id", "none", "content", "packed"]
        )


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over packed texts: key and all grams of each document."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            sets = [shingles(unpacked(t.as_py())) for t in batch.column(0).slice(at, 1000)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.int64()), ragged(sets)],
                names=["key", "grams"],
            )


def ragged(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common grams of every two sets: products of column blocks, summed up."""
    columns, at = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(columns), BLOCK_COLUMNS):
        lo, hi = np.searchsorted(at, (first, first + BLOCK_COLUMNS))
        # Rows without an entry in these columns take no part.
        used, row = np.unique(rows[lo:hi], return_inverse=True)
        block = np.zeros((len(used), min(BLOCK_COLUMNS, len(columns) - first)), np.float32)
        block[row, at[lo:hi] - first] = 1
        total[np.ix_(used, used)] += block @ block.T
    return total


def product(table: pa.Table) -> pa.Table:
    """For `applyInArrow` on one pair of blocks: linked documents and a hub for each set.

    Overlaps are counted over the grams that more than one candidate has; sizes are those
    of the whole sets.  ``hub`` is the smallest key reachable by links within the pair.
    """
    key, n = table["key"].to_numpy(), table["n"].to_numpy()
    weight, side = table["weight"].to_numpy(), table["side"].to_numpy()
    grams = table["grams"].combine_chunks()
    offsets, values = grams.offsets.to_numpy(), grams.values.to_numpy()
    common = overlaps([values[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
    size = n.astype(np.float64)
    linked = 100 * common >= PERCENT * (size[:, None] + size[None, :] - common)
    np.fill_diagonal(linked, False)
    if table["i"][0].as_py() != table["j"][0].as_py():
        # Links within one of the two blocks are counted where it meets itself.
        linked &= side[:, None] != side[None, :]
    hub = key.copy()
    while True:
        reached = np.where(linked, hub[None, :], np.iinfo(np.int64).max).min(axis=1)
        moved = np.minimum(hub, reached)
        if (moved == hub).all():
            break
        hub = moved
    return pa.table({"key": key, "hub": hub, "links": linked @ weight})


def place() -> list[Column]:
    """Where a document stands: its id, whether that is null, and its text's hash."""
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.isnull("doc_id").alias("none"),
        F.col("content"),
    ]


def candidate_sets(docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``key, n, grams`` of the sets that may link, ``grams`` rarest first.

    A set whose prefix shares too little with the prefixes of other sets is left out, then a
    set of which less than the least overlap is found in other remaining sets.  Copies of a
    set are not other sets.  Each time the grams are shuffled once, by value, and windows
    over a value's rows tell how many have it.
    """
    same_gram = Window.partitionBy("gram")
    hits = (
        sketches.select("key", F.explode("prefix").alias("gram"))
        .select("key", F.min("key").over(same_gram).alias("least"), F.max("key").over(same_gram).alias("most"))
        .where("least < most")
        .groupBy("key").agg(F.count("*").alias("hits"))
    )
    # One document for each set is read again.  Every copy of a set counts, so their needs are summed up.
    owners = stored(
        sketches.where("n > 0").groupBy("key")
        .agg(F.first("n").alias("n"), F.sum("need").alias("need"), F.min(F.struct(*place())).alias("owner"))
        .join(hits, "key").where("hits >= need").select("key", "n", "owner.*"),
        "gram-sets",
    )
    at = ["id", "none", "content"]
    # Few documents own a remaining set: the texts of most others are not shuffled.
    texts = marked(docs.select(*place(), "text"), "content", owners).where("marked").drop("marked")
    return stored(
        texts.mapInArrow(pack, PACKED)
        .join(owners, at, "left_semi").dropDuplicates(at)
        .select("packed").mapInArrow(full_sets, SETS)
        .select("key", F.explode("grams").alias("gram"))
        .withColumn("df", F.count("*").over(same_gram)).where("df > 1")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("grams"))
        .join(owners.select("key", "n"), "key")
        .where(100 * F.size("grams") >= PERCENT * F.col("n"))
        .select("key", "n", F.transform("grams", lambda g: g["gram"]).alias("grams")),
        "gram-candidates",
    )


def candidate_components(candidates: DataFrame) -> DataFrame:
    """``node, root``: candidates joined through a gram of their rarest-first prefixes."""
    least = F.ceil(F.col("n") * PERCENT / 100)
    prefix = candidates.select(
        "key",
        F.explode(
            F.slice("grams", F.lit(1), F.greatest(F.lit(1), (F.size("grams") - least + 1).cast("int")))
        ).alias("gram"),
    )
    hubs = prefix.groupBy("gram").agg(F.min("key").alias("hub"))
    edges = prefix.join(hubs, "gram").where("key <> hub")
    return components(edges.select(F.col("key").alias("a"), F.col("hub").alias("b")), "gram-groups")


def links(candidates: DataFrame, groups: DataFrame, weights: DataFrame) -> DataFrame:
    """``key, hub, links`` for every set and pair of blocks it is in.

    The sets of a candidate component are dealt to blocks of bounded rows and entries;
    every two blocks of a component meet in a task of their own.
    """
    # Places are found without the grams, which are shuffled to them and then to their pairs.
    members = candidates.join(groups, F.col("key") == F.col("node")).select(
        "root", "key", F.size("grams").alias("entries")
    )
    blocks = members.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("entries") / BLOCK_ENTRIES)).alias("blocks")
    )
    places = (
        members.drop("entries").join(blocks, "root").join(weights, "key")
        .withColumn("side", F.pmod(F.xxhash64("key"), "blocks"))
    )
    dealt = candidates.join(places, "key")
    pairs = (
        dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("i", F.least("side", "other"))
        .withColumn("j", F.greatest("side", "other"))
        .drop("other", "blocks")
    )
    return pairs.groupBy("root", "i", "j").applyInArrow(product, PRODUCT)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for every row.

    A document's set holds its distinct 5-word shingles; a shorter document is one shingle,
    one without words (or null) is empty and links with nothing.  ``component_id`` is the
    smallest ``doc_id`` reachable by links, itself included, and ``n_links`` the number of
    other rows it links with.  Equal sets are one node, so copies are never paired.  Null
    ids take part but are no component's smallest id unless it has no other.  Rows with the
    same id are separate documents.  An empty table gives no rows.
    """
    return _joined(docs, id_col, text_col).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links"
    )


def _joined(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    named = pick(docs, id_col, text_col).toDF("doc_id", "text").withColumn(
        "content", F.xxhash64("text")
    )
    # Row numbers stand for documents and sets where their n-grams are shuffled: they are
    # small, and fixed by being stored.
    sketches = stored(
        named.mapInArrow(sketch, SKETCH).withColumn("rid", F.monotonically_increasing_id()),
        "gram-sketches",
    )
    candidates = candidate_sets(named, sketches)
    weights = sketches.where("n > 0").groupBy("key").agg(F.count("*").alias("weight"))
    found = stored(
        links(candidates, candidate_components(candidates), weights), "gram-links"
    )
    roots = components(found.select(F.col("key").alias("a"), F.col("hub").alias("b")), "gram-links")
    degrees = found.groupBy("key").agg(F.sum("links").alias("links"))
    rooted = (
        sketches.select("doc_id", "content", "key", "n")
        .join(roots.withColumnRenamed("node", "key"), "key", "left")
        .join(degrees, "key", "left")
        .join(weights, "key", "left")
        .withColumn("root", F.coalesce("root", "key"))
    )
    smallest = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return rooted.join(smallest, "root", "left").select(
        "doc_id", "content", "n", "root",
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("weight") - 1 + F.coalesce("links", F.lit(0)))
        .otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, that with the smallest id, with all its columns.

    Null ids count as largest; of rows with one id the one whose text has the smaller hash
    stays, and of rows with equal id and text any.  Every row without words stays.
    """
    # Rows that link with none stay where they are; only the others are looked up.
    grouped = stored(
        _joined(docs, id_col, text_col).where("n_links > 0").select(*place(), "root"), "gram-grouped"
    )
    at = ["id", "none", "content"]
    kept = grouped.groupBy("root").agg(F.min(F.struct("none", "id", "content")).alias("x")).select("x.*")
    gone = grouped.select(*at).distinct().join(kept, at, "left_anti")
    packed = with_row(docs, id_col, text_col).toDF("doc_id", "text", "row").withColumn(
        "content", F.xxhash64("text")
    )
    wordless = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), SEPARATORS + "+", "")) == 0
    judged = marked(packed.select(*place(), "row", wordless.alias("wordless")), "content", grouped)
    looked_up = F.col("marked") & ~F.col("wordless")
    stay = judged.where(looked_up).join(gone, at, "left_anti").dropDuplicates(at)
    return rows_of(
        judged.where(~looked_up).select("row").unionByName(stay.select("row")), docs
    )
