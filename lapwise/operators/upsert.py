"""Insert new keys, update changed rows, leave the rest alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lapwise.operators.tables import BUCKET, BucketTable, exists
from lapwise.session import passing, release, stored

INSERT, UPDATE, SAME = "insert", "update", "same"

# Rows of both sides that meet at one time, and most parts a batch is cut into for that.  A
# bucket is not cut.
PART_ROWS = 4_000_000
MOST_PARTS = 16

# First byte of a packed text: a digest as bytes, or any other text as it is.
DIGEST, TEXT = bytes([1]), bytes([0])


@dataclass(frozen=True)
class UpsertReport:
    inserted: int
    updated: int
    unchanged: int

    @property
    def changed(self) -> bool:
        return self.inserted + self.updated > 0


def packed(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the named text columns as bytes, of which a SHA-256 in hex takes half as many.

    Equal bytes are equal texts, and `unpacked` gives the texts back.
    """
    kinds, texts = dict(rows.dtypes), {}
    for name in names:
        if kinds[name] == "string":
            text = F.col(name)
            texts[name] = F.when(
                text.rlike("^[0-9a-f]{64}\\z"), F.concat(F.lit(DIGEST), F.unhex(text))
            ).otherwise(F.concat(F.lit(TEXT), text.cast("binary")))
    return rows.withColumns(texts)


def unpacked(rows: DataFrame, *names: str) -> DataFrame:
    kinds, texts = dict(rows.dtypes), {}
    for name in names:
        if kinds[name] == "binary":
            digest = F.substring(name, 1, 1) == F.lit(DIGEST)
            content = F.substring(F.col(name), F.lit(2), F.octet_length(name))
            texts[name] = F.when(digest, F.lower(F.hex(content))).otherwise(content.cast("string"))
    return rows.withColumns(texts)


def classify(target: DataFrame, source: DataFrame, key: str, digest: str = "row_hash") -> DataFrame:
    """Each source key with what the upsert does to it; reads only key and hash columns."""
    old = target.select(key, F.col(digest).alias("__old"))
    return source.join(old, key, "left").select(
        *source.columns,
        F.when(F.col("__old").isNull(), INSERT)
        .when(F.col("__old") != F.col(digest), UPDATE)
        .otherwise(SAME)
        .alias("change"),
    )


def merged(
    target: DataFrame,
    source: DataFrame,
    key: str,
    now: Column,
    digest: str = "row_hash",
    carried: Sequence[str] = (),
) -> DataFrame:
    """The next state of ``target``: a full outer join with keys unique on both sides.

    ``carried`` are target columns that survive an update (none besides the insert
    time by default).  Rows present only in the target are never deleted.
    """
    t, s = target.alias("t"), source.alias("s")
    is_new = F.col(f"t.{key}").isNull()
    is_changed = F.col(f"s.{digest}") != F.col(f"t.{digest}")
    taken = F.col(f"s.{key}").isNotNull() & (is_new | is_changed)
    stamps = {"dw_inserted_at", "dw_updated_at"}
    columns = [
        F.when(taken, F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")).alias(c)
        for c in target.columns
        if c not in stamps and c not in carried
    ]
    kept = [F.col(f"t.`{c}`") for c in carried]
    return t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer").select(
        *columns,
        *kept,
        F.when(is_new, now).otherwise(F.col("t.dw_inserted_at")).alias("dw_inserted_at"),
        F.when(taken, now).otherwise(F.col("t.dw_updated_at")).alias("dw_updated_at"),
    )


def only_buckets(table: DataFrame, buckets: DataFrame) -> DataFrame:
    """Rows of the listed ``buckets``; files of others are not opened.

    The range of the buckets is a filter on the partition column.  Within the range the join
    prunes at run time (a filter on its small side is what makes Spark do so).
    """
    ends = buckets.agg(F.min(BUCKET).alias("low"), F.max(BUCKET).alias("high")).first()
    if ends["low"] is None:
        return table.limit(0)
    within = F.col(BUCKET).between(ends["low"], ends["high"])
    return table.filter(within).join(buckets.filter(within), BUCKET, "left_semi")


def upsert(
    table: BucketTable,
    source: DataFrame,
    key: str,
    now: Column,
    announce: Callable[[DataFrame], None] | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    buckets: DataFrame | None = None,
) -> UpsertReport:
    """Apply ``source`` (unique keys, with ``bucket`` and ``row_hash``) to a stored table.

    The source is written once to the shared folder and read back from there.  ``finish`` adds,
    row by row, what need not be stored or shuffled: key and hash, if they are long.  Only
    buckets holding an insert or update are rewritten; a batch without changes writes
    nothing.  Where the table has none of the source's buckets every row is new, and they are
    written without a join; if it has no bucket at all and ``buckets`` lists the source's, the
    source is not stored either.  ``announce`` is given the buckets before the table changes.
    A run that dies is completed by repeating it.

    Both sides meet part by part, each some buckets, and digests are shuffled as bytes: on disk
    there is one part's share of the shuffles and of the rewritten rows beside the table.
    """

    def added(rows: DataFrame, touched: DataFrame) -> UpsertReport:
        touched = stored(touched, "upsert-buckets")
        if touched.isEmpty():
            return UpsertReport(0, 0, 0)
        if announce is not None:
            announce(touched)
        seen = Observation()
        stamps = {c: now for c in ("dw_inserted_at", "dw_updated_at")}
        new = finish(rows.hint("rebalance", BUCKET)).withColumns(stamps)
        table.replace(new.observe(seen, F.count("*").alias("n")), touched, gathered=True)
        return UpsertReport(seen.get["n"], 0, 0)

    with passing(table.spark):
        if buckets is not None and not exists(table.spark, table.path):
            return added(source, buckets.select(BUCKET).distinct())
        raw = stored(source, "upsert")
        release(table.spark)
        arriving = raw.select(BUCKET).distinct()
        reached = only_buckets(table.read(), arriving)
        if reached.isEmpty():
            return added(raw, arriving)
        totals = {INSERT: 0, UPDATE: 0, SAME: 0}
        for part in bucket_parts(reached, raw):
            for change, n in _apply(table, raw.filter(part), key, now, announce, finish).items():
                totals[change] += n
        return UpsertReport(totals[INSERT], totals[UPDATE], totals[SAME])


def bucket_parts(reached: DataFrame, source: DataFrame) -> list[Column]:
    """Conditions that deal the buckets into parts of about `PART_ROWS` rows of both sides."""
    steps = [i / MOST_PARTS for i in range(1, MOST_PARTS)]
    met = reached.select(BUCKET).unionByName(source.select(BUCKET)).agg(
        F.count("*").alias("n"), F.percentile_approx(BUCKET, steps, 1000).alias("bounds")
    ).first()
    parts = min(MOST_PARTS, -(-met["n"] // PART_ROWS))
    taken = sorted({met["bounds"][i * MOST_PARTS // parts - 1] for i in range(1, parts)} if met["bounds"] else ())
    bucket, out, low = F.col(BUCKET), [], None
    for high in [*taken, None]:
        above = bucket.isNull() if low is None else F.lit(False)
        inside = F.lit(True) if low is None else bucket > low
        out.append(above | (inside if high is None else inside & (bucket <= high)))
        low = high
    return out


def _apply(
    table: BucketTable,
    raw: DataFrame,
    key: str,
    now: Column,
    announce: Callable[[DataFrame], None] | None,
    finish: Callable[[DataFrame], DataFrame],
) -> dict[str, int]:
    """Upsert the stored rows of some buckets; returns how many keys each kind of change has."""
    digests = [key, "row_hash"]
    current, staged = packed(table.read(), *digests), packed(finish(raw), *digests)
    reached = only_buckets(current, raw.select(BUCKET).distinct())
    changes = classify(reached, staged.select(key, BUCKET, "row_hash"), key)
    counts = stored(
        changes.groupBy(BUCKET, "change").agg(F.count("*").alias("n")), "upsert-counts"
    )
    release(table.spark)
    # One row for each of the three kinds.
    totals = {r["change"]: r["n"] for r in counts.groupBy("change").agg(F.sum("n").alias("n")).collect()}
    if totals.keys() - {SAME}:
        touched = counts.filter(F.col("change") != SAME).select(BUCKET).distinct()
        if announce is not None:
            announce(touched)
        rows = merged(
            only_buckets(current, touched), staged.join(touched, BUCKET, "left_semi"), key, now
        )
        table.replace(unpacked(rows.hint("rebalance", BUCKET), *digests), touched, gathered=True)
    return totals
