"""Repeated byte strings removed: suffix arrays over the text around repeated minimizers.

Two equal strings of ``LENGTH`` bytes have the same smallest hash among their ``GRAM``-byte
pieces.  Texts are therefore cut into segments of consecutive windows with one smallest
piece; equal windows always lie in different segments, of that piece's hash.  Hashes that occur once are done
with.  Of the others, segments with equal bytes keep their first occurrence, and where a
hash has different segments these meet in a bin, whose suffix array shows the windows that
occur more than once.  Segments of a hash too large for a bin are taken apart into windows,
of which equal ones meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.llm.common import packed_text, pick, rows_of, unpacked, with_row
from lapwise.session import stored

LENGTH = 100
GRAM = 32
SPAN = LENGTH - GRAM + 1

# Windows looked at in one go; a power of two.
CHUNK = 1 << 17

# Bytes of segments that one task sorts.
BIN_BYTES = 4_000_000

# Bytes of text whose equal segments are found before anything is shuffled.
CHUNK_BYTES = 16 << 20

# Bits kept of the two hashes: of a piece, where a false match only costs a comparison, and
# of a segment's bytes, which is compared among segments of one piece.
HASH_BITS = np.int64((1 << 48) - 1)

SEGMENTS = "kind int, h long, g long, rid long, start int, windows int"
PIECES = "h long, rid long, start int, piece binary"
WINDOWS = "w binary, rid long, start int"
SPANS = "rid long, begin int, finish int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

# Odd multipliers of the hashes, from the golden ratio and the square roots of primes.
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B, 0xA54FF53A5F1D36F1,
     0x510E527FADE682D1, 0x9B05688C2B3E6C1F, 0x1F83D9ABFB41BD6B], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MULTIPLIERS[0]
    return x ^ (x >> np.uint64(29))


def window_hashes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pieces of ``GRAM`` and of twice ``GRAM`` bytes, by doubling."""
    h = _mixed((text.astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[1])
    size, level, gram = 1, 2, h
    while size < 2 * GRAM:
        h = _mixed(h[: len(h) - size] * MULTIPLIERS[level] + h[size:])
        size *= 2
        level = 2 + level % 5
        if size == GRAM:
            gram = h
    return gram, h


def leftmost_least(gram: np.ndarray) -> np.ndarray:
    """For every ``SPAN`` neighbours the place of the smallest, by doubling.

    The place is kept in the low bits of the hash, so of equal ones the leftmost wins.
    """
    low = np.uint64(2 * CHUNK - 1)
    key = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while 2 * size <= SPAN:
        key = np.minimum(key[: len(key) - size], key[size:])
        size *= 2
    key = np.minimum(key[: len(key) - (SPAN - size)], key[SPAN - size :])
    return (key & low).astype(np.int64)


def segments(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, digest, start and number of windows of each segment of a text."""
    if len(text) < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none
    gram, double = window_hashes(text)
    count = len(text) - LENGTH + 1
    chosen = np.concatenate([
        at + leftmost_least(gram[at : at + CHUNK + SPAN - 1]) for at in range(0, count, CHUNK)
    ])
    start = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    windows = np.diff(np.concatenate([start, [count]]))
    size = windows + LENGTH - 1
    digest = _mixed(
        double[start] * MULTIPLIERS[3]
        + double[start + (size - 2 * GRAM) // 2] * MULTIPLIERS[4]
        + double[start + size - 2 * GRAM] * MULTIPLIERS[5]
        + size.astype(np.uint64)
    )
    return gram[chosen[start]].view(np.int64), digest.view(np.int64), start, windows


def _record(kinds: list[pa.DataType], names: str, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)],
        names=[n.split()[0] for n in names.split(", ")],
    )


SEGMENT_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def chunk_segments(rid: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
    """Segments of some documents: of equal ones the first as candidate, the rest as copies.

    Copies that follow one another in a document are one row.
    """
    found = [segments(np.frombuffer(t, np.uint8)) for t in texts]
    counts = [len(f[0]) for f in found]
    h, g, start, windows = (np.concatenate([f[i] for f in found]) for i in range(4))
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((start, rid[owner], g, h))
    first = np.ones(len(order), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    copy = np.ones(len(order), bool)
    copy[order[first]] = False
    # Neighbouring segments of a document have neighbouring windows.
    joined = np.zeros(len(order), bool)
    joined[1:] = copy[1:] & copy[:-1] & (owner[1:] == owner[:-1])
    begins = np.flatnonzero(~joined)
    windows = np.add.reduceat(windows, begins) if len(begins) else windows
    return _record(SEGMENT_KINDS, SEGMENTS, [
        copy[begins].astype(np.int32), h[begins] & HASH_BITS, g[begins] & HASH_BITS,
        rid[owner[begins]], start[begins].astype(np.int32), windows.astype(np.int32),
    ])


def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over ``rid, packed``: segments, chunk by chunk."""
    for batch in batches:
        rid, at, texts, size = batch.column(0).to_numpy(), 0, [], 0
        for i in range(batch.num_rows + 1):
            if texts and (i == batch.num_rows or size >= CHUNK_BYTES):
                yield chunk_segments(rid[at:i], texts)
                at, texts, size = i, [], 0
            if i < batch.num_rows:
                texts.append(unpacked(batch.column(1)[i].as_py()))
                size += len(texts[-1])


def matched_segments(most: int):
    """For `mapInArrow` over candidates sorted by ``h, g`` and document order.

    Candidates whose hash stands alone are dropped; further ones of equal bytes come out as
    copies (kind 1), the first ones of a hash with different bytes to be compared (kind 0).
    A hash whose first ones have more than ``most`` bytes is named (kind 2).  Only the first
    one of the last hash waits, for a second one.
    """
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last hash and digest, the row that waits, and how many first ones and bytes
        # the last hash has so far.
        last_h = last_g = waiting = None
        number = size = 0

        def named(large: np.ndarray) -> pa.RecordBatch:
            none = np.zeros(len(large), np.int64)
            kind = np.full(len(large), 2, np.int32)
            return _record(SEGMENT_KINDS, SEGMENTS, [
                kind, large, none, none, none.astype(np.int32), none.astype(np.int32)
            ])

        for batch in batches:
            h, g = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            if not len(h):
                continue
            new_hash = np.concatenate([[h[0] != last_h], h[1:] != h[:-1]])
            first = new_hash | np.concatenate([[g[0] != last_g], g[1:] != g[:-1]])
            # Run 0 goes on with the hash of the batch before.
            run = np.cumsum(new_hash)
            numbers = np.bincount(run[first], minlength=run[-1] + 1)
            bytes_here = np.where(first, batch.column(5).to_numpy().astype(np.int64) + LENGTH, 0)
            sizes = np.bincount(run, bytes_here, minlength=run[-1] + 1).astype(np.int64)
            numbers[0] += number
            sizes[0] += size
            if waiting is not None and numbers[0] > 1:
                yield waiting
                waiting = None
            out = np.flatnonzero(~first | (numbers[run] > 1))
            yield _record(SEGMENT_KINDS, SEGMENTS, [
                (~first[out]).astype(np.int32), *(batch.column(i).take(pa.array(out)) for i in range(1, 6))
            ])
            hash_of_run = np.zeros(run[-1] + 1, np.int64)
            hash_of_run[0] = last_h if last_h is not None else 0
            hash_of_run[run] = h
            yield named(hash_of_run[:-1][sizes[:-1] > most])
            number, size = int(numbers[-1]), int(sizes[-1])
            if run[-1] > 0:
                waiting = None
            alone = np.flatnonzero(first & (run == run[-1]))
            if number == 1 and len(alone):
                waiting = _record(SEGMENT_KINDS, SEGMENTS, [
                    batch.column(i).slice(int(alone[0]), 1) for i in range(6)
                ])
            last_h, last_g = h[-1], g[-1]
        if size > most:
            yield named(np.array([last_h], np.int64))

    return match


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over ``text`` and more: the text compressed, to travel."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            packed = [packed_text(t.as_py()) for t in part.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed, pa.binary()), *part.columns[1:]],
                names=["packed", *part.schema.names[1:]],
            )


def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: the bytes of the listed segments of each document."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            text, listed = unpacked(row["packed"]), row["listed"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x["h"] for x in listed], pa.int64()),
                    pa.array([row["rid"]] * len(listed), pa.int64()),
                    pa.array([x["start"] for x in listed], pa.int32()),
                    pa.array([text[x["start"] : x["start"] + x["windows"] + LENGTH - 1] for x in listed], pa.binary()),
                ],
                names=names,
            )


def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: digests of the windows of the listed segments of each document."""
    for batch in batches:
        for row in batch.to_pylist():
            text = unpacked(row["packed"])
            places = [i for x in row["listed"] for i in range(x["start"], x["start"] + x["windows"])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.md5(text[i : i + LENGTH]).digest() for i in places], pa.binary()),
                    pa.array([row["rid"]] * len(places), pa.int64()),
                    pa.array(places, pa.int32()),
                ],
                names=[c.split()[0] for c in WINDOWS.split(", ")],
            )


def _word(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number that sorts like them."""
    return text[at[:, None] + np.arange(8)].view(">u8").ravel().astype(np.uint64)


def sorted_directly(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """``places`` in the order of the ``LENGTH`` bytes there, ties in any order."""
    word = _word(text, places)
    order = np.argsort(word, kind="stable")
    places, word = places[order], word[order]
    group = np.concatenate([[0], np.cumsum(word[1:] != word[:-1])]) if len(places) else places
    for depth in range(8, LENGTH, 8):
        # Only places tied so far are looked at again.
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(tied):
            break
        word = _word(text, places[tied] + depth)
        order = np.lexsort((word, group[tied]))
        places[tied] = places[tied[order]]
        word, old = word[order], group[tied]
        fresh = np.concatenate([[True], (old[1:] != old[:-1]) | (word[1:] != word[:-1])])
        # A new group is named by the place of its first member.
        group = np.arange(len(places))
        group[tied] = tied[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    return places


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """Suffixes of ``text[:size]`` in the order of at least their first ``LENGTH`` bytes.

    Two stages.  Suffixes smaller than their successor are sorted directly.  The others
    follow from one scan of the buckets of first bytes in ascending order: when a bucket is
    complete, the suffixes one place to the left that start with a greater byte are next in
    their buckets.  Within a bucket these come before the directly sorted ones; a run of one
    byte is followed inside its bucket.
    """
    body = text[:size]
    differs = np.flatnonzero(text[:size] != text[1 : size + 1])
    following = np.searchsorted(differs, np.arange(size))
    ends = np.where(following < len(differs), differs[np.minimum(following, len(differs) - 1)], size - 1)
    smaller = text[ends] < text[ends + 1]
    direct = sorted_directly(text, np.flatnonzero(smaller))
    direct_starts = np.searchsorted(body[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    # The place after the end is the smallest suffix.
    if not smaller[size - 1]:
        waiting[body[size - 1]].append(np.array([size - 1]))
    out = []
    for byte in range(256):
        induced = waiting[byte]
        front = np.concatenate(induced) if induced else np.empty(0, np.int64)
        bucket = [front]
        while len(front):
            left = front[front > 0] - 1
            front = left[body[left] == byte]
            bucket.append(front)
        bucket.append(direct[direct_starts[byte] : direct_starts[byte + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        left = whole[whole > 0] - 1
        left = left[body[left] > byte]
        if len(left):
            start = body[left]
            order = np.argsort(start, kind="stable")
            left, start = left[order], start[order]
            cuts = np.flatnonzero(start[1:] != start[:-1]) + 1
            for group in np.split(left, cuts):
                waiting[body[group[0]]].append(group)
    return np.concatenate(out)


def adjacent_common(text: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Whether each suffix after the first has ``LENGTH`` bytes in common with the one before."""
    equal = np.ones(max(len(suffixes) - 1, 0), bool)
    for depth in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        still = np.flatnonzero(equal)
        equal[still] = _word(text, suffixes[still] + depth) == _word(text, suffixes[still + 1] + depth)
    return equal


def repeated_spans(table: pa.Table) -> pa.Table:
    """For `applyInArrow` on one bin of pieces: spans of windows that occur earlier in it."""
    table = table.sort_by([(c, "ascending") for c in ("rid", "start")])
    pieces = table["piece"].to_pylist()
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    # Pieces in document order, each with a zero byte behind; places then sort like windows.
    text = np.frombuffer(b"\x00".join(pieces) + bytes(2 * LENGTH), np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    size = int(sizes.sum() + len(sizes))
    piece = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.arange(size) - first[piece]
    suffixes = suffix_array(text, size)
    suffixes = suffixes[inside[suffixes] <= sizes[piece[suffixes]] - LENGTH]
    run = np.concatenate([[0], np.flatnonzero(~adjacent_common(text, suffixes)) + 1])
    earliest = np.minimum.reduceat(suffixes, run)
    later = np.ones(size, bool)
    later[earliest] = False
    later[inside > (sizes - LENGTH)[piece]] = False
    edges = np.diff(np.concatenate([[0], later.view(np.int8), [0]]))
    begin, finish = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    where = pa.array(piece[begin])
    start = table["start"].to_numpy()
    return pa.table({
        "rid": table["rid"].take(where),
        "begin": pa.array((start[piece[begin]] + inside[begin]).astype(np.int32)),
        "finish": pa.array((start[piece[finish]] + inside[finish] + LENGTH).astype(np.int32)),
    })


def removed_runs(begin: list[int] | None, finish: list[int] | None) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans."""
    runs: list[tuple[int, int]] = []
    for b, f in sorted(zip(begin or (), finish or ())):
        if runs and b <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(f, runs[-1][1]))
        else:
            runs.append((b, f))
    return runs


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(f for _, f in runs)]
    starts = [*(b for b, _ in runs), len(text)]
    return b"".join(text[e:s] for e, s in zip(ends, starts))


def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: the result row of each document."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text = unpacked(row["packed"])
            runs = removed_runs(row["begins"], row["finishes"])
            rows.append((
                row["doc_id"], len(text), sum(f - b for b, f in runs), len(runs),
                hashlib.sha256(kept_bytes(text, runs)).hexdigest(),
            ))
        columns = list(zip(*rows)) if rows else [[]] * 5
        types = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=[c.split()[0] for c in RESULT.split(", ")],
        )


def whole_characters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs widened so that a character that loses a byte goes as a whole."""
    def inside(i: int) -> bool:
        return i < len(text) and text[i] & 0xC0 == 0x80

    wide = []
    for b, f in runs:
        while inside(b):
            b -= 1
        while inside(f):
            f += 1
        wide.append((b, f))
    return removed_runs([b for b, _ in wide], [f for _, f in wide])


def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: what is left of each text, beside the packed row."""
    for batch in batches:
        texts = []
        for row in batch.drop_columns(["row"]).to_pylist():
            text = unpacked(row["packed"])
            runs = whole_characters(text, removed_runs(row["begins"], row["finishes"]))
            texts.append(None if row["packed"] is None else kept_bytes(text, runs).decode())
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), batch.column("row")], names=["text", "row"]
        )


def numbered(docs: DataFrame, more: T.StructType = T.StructType()) -> DataFrame:
    """Every row of ``doc_id, u, v, text`` once, stored with a number ``rid`` of its own.

    The numbers ascend with ``doc_id`` (null first), ``u`` and ``v``; a random last key
    spreads equal rows over partitions.
    """
    order = ["doc_id", "u", "v", "tie"]
    kinds = T.StructType([
        T.StructField("packed", T.BinaryType()), T.StructField("doc_id", T.LongType()),
        T.StructField("u", T.IntegerType()), T.StructField("v", T.LongType()),
        T.StructField("tie", T.DoubleType()), *more.fields,
    ])
    return stored(
        docs.withColumn("tie", F.rand(1)).select("text", *order, *more.names)
        .mapInArrow(pack_texts, kinds)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("rid"), "doc_id", "packed", *more.names),
        "numbered-texts",
    )


def spans(texts: DataFrame) -> DataFrame:
    """``rid, begin, finish`` of repeated strings in ``rid, packed``, in the order of ``rid``."""
    cut = texts.select("rid", "packed").mapInArrow(cut_segments, SEGMENTS)
    found = stored(
        cut.where("kind = 0").repartition("h")
        .sortWithinPartitions("h", "g", "rid", "start")
        .mapInArrow(matched_segments(BIN_BYTES), SEGMENTS)
        .drop("g"),
        "matched-segments",
    )
    copies = (
        cut.where("kind = 1").drop("g").unionByName(found.where("kind = 1"))
        .select("rid", F.col("start").alias("begin"),
                (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("finish"))
    )
    listed = found.where("kind = 0").drop("kind")
    # At most one for each ``BIN_BYTES`` of segments.
    large = found.where("kind = 2").select("h")
    some_large = not large.isEmpty()
    binned = listed.join(F.broadcast(large), "h", "left_anti") if some_large else listed
    total = binned.agg(F.sum(F.col("windows") + LENGTH)).first()[0] or 0

    def beside_text(chosen: DataFrame) -> DataFrame:
        wanted = chosen.groupBy("rid").agg(F.collect_list(F.struct("h", "start", "windows")).alias("listed"))
        return texts.select("rid", "packed").join(wanted, "rid")

    pieces = beside_text(binned).mapInArrow(cut_pieces, PIECES).withColumn(
        "bin", F.expr(f"pmod(xxhash64(h), {total // BIN_BYTES + 1})")
    )
    compared = pieces.groupBy("bin").applyInArrow(repeated_spans, SPANS)
    if some_large:
        # However many windows are equal, they are sorted and passed one by one.
        nth = F.row_number().over(Window.partitionBy("w").orderBy("rid", "start"))
        windows = beside_text(listed.join(F.broadcast(large), "h", "left_semi")).mapInArrow(cut_windows, WINDOWS)
        later = windows.withColumn("nth", nth).where("nth > 1")
        compared = compared.unionByName(
            later.select("rid", F.col("start").alias("begin"), (F.col("start") + LENGTH).alias("finish"))
        )
    return copies.unionByName(compared)


def _with_spans(docs: DataFrame, more: T.StructType = T.StructType()) -> DataFrame:
    """Each row with its spans."""
    texts = numbered(docs, more)
    listed = spans(texts).groupBy("rid").agg(F.collect_list(F.struct("begin", "finish")).alias("s"))
    return texts.join(listed, "rid", "left").select(
        "doc_id", "packed",
        F.col("s.begin").alias("begins"), F.col("s.finish").alias("finishes"), *more.names,
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row.

    A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier, in
    a smaller id or earlier in the same text; strings are judged on the input.  A null text
    is empty.  Null ids come before all others.  Rows with one id are ordered by hashes of
    their text; of rows with equal id and text one counts as first and the others lose
    every byte if they have ``LENGTH``.  An empty table gives no rows.
    """
    named = pick(docs, id_col, text_col).toDF("doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("text").alias("u"),
        F.xxhash64("text").alias("v"),
    )
    return _with_spans(named).mapInArrow(report, RESULT)


def dedup_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars"
) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut from their text; no row goes.

    Characters that lose a byte go as a whole.  Rows with one id are ordered by hashes of
    the row.  A column ``length_col``, if there is one, gets the new number of characters.
    """
    at = docs.columns.index(text_col)
    # The text travels compressed and not in the row as well.
    textless = F.col("row").withField(f"c{at}", F.lit(None).cast("string"))
    packed = with_row(docs, id_col, text_col).toDF("doc_id", "text", "row").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.hash("row").alias("u"),
        F.xxhash64("row").alias("v"), textless.alias("row"),
    )
    kind = packed.schema["row"].dataType
    cut = _with_spans(packed, T.StructType([T.StructField("row", kind)])).mapInArrow(
        rewrite, T.StructType([T.StructField("text", T.StringType()), T.StructField("row", kind)])
    )
    fresh = {text_col: F.col("text"), length_col: F.length("text").cast("long")}
    replaced = cut.select(
        F.struct(
            *[fresh.get(name, F.col(f"row.c{i}")).alias(f"c{i}") for i, name in enumerate(docs.columns)]
        ).alias("row")
    )
    return rows_of(replaced, docs)
