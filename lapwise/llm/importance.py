"""Importance resampling: hashed n-gram models of target and raw text, Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.common import pick, running_totals
# Buckets that unigrams and bigrams are hashed into: the size of both models.
BUCKETS = 1 << 14

# Labelled documents that the target model is fitted on, at most.
TARGET_SAMPLE = 20_000

# Bytes of text counted in one go.
SLICE_BYTES = 1 << 20

COUNTS = "bucket int, raw long, target long"
SCORED = "doc_id long, content long, n_grams long, log_weight double"

_rng = np.random.default_rng(6)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
PLACE_VALUES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
PAIR = np.uint64(0x9E3779B97F4A7C15)


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """0 white space, 1 letter, digit or non-ASCII, 2 other; and ASCII lower case."""
    kind = np.full(256, 2, np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[128:] = 1
    for c in b"0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
        kind[c] = 1
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kind, lower


KIND, LOWER = _byte_classes()


def gram_buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the unigrams and bigrams of all texts, and the text each is from.

    Tokens are runs of letters and digits or runs of other marks, in ASCII lower case.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    kind = KIND[data]
    before = np.concatenate([[0], kind[:-1]])
    start = np.flatnonzero((kind != before) & (kind != 0))
    stop = np.flatnonzero((kind != before) & (before != 0))
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Every token's bytes, one after the other.
    size = stop - start
    first = np.cumsum(size) - size
    inside = np.arange(size.sum()) - np.repeat(first, size)
    value = BYTE_VALUES[LOWER[data[np.repeat(start, size) + inside]]] * PLACE_VALUES[inside & 63]
    value = np.add.reduceat(value ^ (value >> np.uint64(31)), first)
    text = np.searchsorted(ends, start, side="right")
    inner = np.flatnonzero(text[1:] == text[:-1])
    pairs = (value[inner] ^ (value[inner] >> np.uint64(29))) * PAIR + value[inner + 1]
    grams = np.concatenate([value, pairs])
    grams = (grams ^ (grams >> np.uint64(32))) * PAIR
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    return (grams >> shift).astype(np.int64), np.concatenate([text, text[inner]])


def sliced(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes in slices of bounded size (a single text may be larger)."""
    at, held, size = 0, [], 0
    for i, text in enumerate(column):
        data = (text.as_py() or "").encode()
        if held and size + len(data) > SLICE_BYTES:
            yield at, held
            at, held, size = i, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield at, held


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow` over ``text, target``: the partition's counts in each bucket."""
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        flags = batch.column(1).to_numpy(zero_copy_only=False)
        for at, texts in sliced(batch.column(0)):
            bucket, text = gram_buckets(texts)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[flags[at + text]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(raw[used]), pa.array(target[used])],
        names=["bucket", "raw", "target"],
    )


def scorer(ratio: np.ndarray):
    """For `mapInArrow` over ``doc_id, content, text``: the log importance of each text."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums = [], []
            for _, texts in sliced(batch.column(2)):
                bucket, text = gram_buckets(texts)
                counts.append(np.bincount(text, minlength=len(texts)))
                # Buckets are summed in order, so equal texts get equal sums.
                sums.append(np.bincount(text, weights=ratio[bucket], minlength=len(texts)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array(np.concatenate([*counts, []]), pa.int64()),
                    pa.array(np.concatenate([*sums, []]), pa.float64()),
                ],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )

    return score


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability of each bucket, add-one smoothed."""
    return (
        np.log(target + 1.0) - np.log(target.sum() + BUCKETS)
        - np.log(raw + 1.0) + np.log(raw.sum() + BUCKETS)
    )


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    sample: int = TARGET_SAMPLE,
    seed: int = 6,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """``doc_id, n_grams, log_weight, gumbel_key, place, kept`` for every row.

    Two bags of hashed unigrams and bigrams are counted: raw over all documents, target over
    at most ``sample`` documents labelled 1, chosen by a hash of their id.  A document's log
    weight is the sum of the log ratios of its n-grams; a Gumbel variate drawn from a hash
    of id and text is added, and the ``share`` with the greatest keys is kept, which is a
    draw without replacement in proportion to the weights.  Without a given share it is that
    of label 1 among the labelled documents.

    A null or empty text has weight 0.  Null ids are scored; equal rows get equal keys, in
    order of places as they come.  Without labels 1 the target is empty and the weights are
    those of the smoothing alone.  An empty table gives no rows.
    """
    named = pick(docs, id_col, text_col).toDF("doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("content"), "text"
    )
    marked = pick(labels, id_col, label_col).toDF("d", "y").where("d is not null").groupBy("d").agg(
        F.max("y").alias("y")
    )
    if share is None:
        share = marked.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0]
        share = 1.0 if share is None else share
    # At most ``sample`` ids.
    chosen = marked.where("y = 1").orderBy(F.xxhash64("d"), "d").limit(sample).select("d")
    flagged = named.join(F.broadcast(chosen), F.col("doc_id") == F.col("d"), "left").select(
        "text", F.col("d").isNotNull().alias("target")
    )
    counts = flagged.mapInArrow(count_grams, COUNTS).groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    # One row for each bucket.
    for row in counts.collect():
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "content"), 11) + 0.5) / float(1 << 53)
    scored = named.select("doc_id", "content", "text").mapInArrow(
        scorer(log_ratio(raw, target)), SCORED
    )
    keyed = scored.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))).withColumn(
        "down", -F.col("gumbel_key")
    ).withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(keyed, ["down", "doc_id"], {"place": "one"}, "gumbel-keys")
    return ranked.select(
        "doc_id", "n_grams", "log_weight", "gumbel_key", "place",
        (F.col("place") < F.round(F.col("all_place") * share)).alias("kept"),
    )
