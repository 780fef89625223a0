import hashlib
import os
import random

import numpy as np
import oracle
import pytest
from cases import edge_docs, edge_rows, order_key, prose
from pyspark.sql import functions as F

from lapwise.llm import oracles, suffix_dedup


def by_hand(ordered):
    """Result rows for texts in document order."""
    seen, out = set(), []
    for d, t in ordered:
        data = (t or "").encode()
        covered = bytearray(len(data))
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                covered[i : i + 100] = b"\x01" * 100
            seen.add(window)
        kept = bytes(b for b, c in zip(data, covered) if not c)
        runs = sum(c and (i == 0 or not covered[i - 1]) for i, c in enumerate(covered))
        out.append((d, len(data), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def answer(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def document_order(spark, rows):
    """Rows with one id are ordered by the hash of their text."""
    hashes = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(rows)], "i int, text string").select(
        "i", F.hash("text").alias("u")
    )
    u = {r.i: r.u for r in hashes.collect()}
    order = sorted(range(len(rows)), key=lambda i: (order_key(rows[i][0]), u[i]))
    return [rows[i][:2] for i in order]


def test_against_all_windows(spark):
    rows = edge_rows()
    assert answer(suffix_dedup.dedup(edge_docs(spark))) == by_hand(document_order(spark, rows))


def test_shared_passages_overlaps_and_periods(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BIN_BYTES", 3000)
    rng = random.Random(4)
    passages = [prose(20 + i, 40) for i in range(6)]
    rows = []
    for i in range(50):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            passage = rng.choice(passages)
            a = rng.randrange(0, 80)
            parts.append(passage[a : a + rng.randrange(60, 260)])
            parts.append(prose(1000 + rng.randrange(400), rng.randrange(1, 20)))
        rows.append((i, " ".join(parts), "s"))
    rows += [(100, "ab" * 400, "s"), (101, "abc" * 200 + "ab" * 100, "s"), (102, "\x00" * 400, "s"), (103, "é" * 120, "s")]
    assert answer(suffix_dedup.dedup(edge_docs(spark, rows))) == by_hand([r[:2] for r in rows])


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_is_sorted(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, rng.integers(1, 6) + 1, rng.integers(1, 500)).astype(np.uint8)
    if seed % 3 == 0:
        text = np.repeat(text, rng.integers(1, 40))
    padded = np.concatenate([text, np.zeros(200, np.uint8)])
    order = suffix_dedup.suffix_array(padded, len(text))
    assert sorted(order.tolist()) == list(range(len(text)))
    heads = [bytes(padded[i : i + 100]) for i in order]
    assert heads == sorted(heads)


def test_long_text_is_cut_alike_in_chunks(monkeypatch):
    text = np.frombuffer((prose(9, 4000) + "z" * 700).encode(), np.uint8)
    whole = suffix_dedup.segments(text)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 10)
    parts = suffix_dedup.segments(text)
    windows = lambda s: np.repeat(s[0], s[3])
    assert (windows(whole) == windows(parts)).all()


def test_rows_keep_columns_and_whole_characters(spark):
    rng = random.Random(5)
    accents = "".join(rng.choice("àáâãäåæçèéêëìíîïðñòóôõö") for _ in range(60))
    rows = [(1, accents + ". " + prose(30, 40), "s"), (2, "ÿ" + accents + "ÿend", "s"), (3, None, "s"), (4, prose(30, 40), "s")]
    docs = edge_docs(spark, rows)
    cut = suffix_dedup.dedup_rows(docs)
    assert cut.columns == docs.columns and cut.dtypes == docs.dtypes
    names = [f"c{i}" for i in range(len(docs.columns))]
    got = {r.c0: (r.c1, r.c10) for r in cut.toDF(*names).collect()}
    assert got[1] == (rows[0][1], len(rows[0][1]))
    assert got[2] == ("ÿÿend", 5)
    assert got[3] == (None, None)
    assert len(got[4][0]) < len(rows[3][1])


def test_first_of_equal_rows_keeps_its_text(spark):
    rows = edge_rows() + [(200, prose(970, 40), "s")] * 3 + [(None, prose(971, 40), "s")] * 2 + [(201, prose(972, 40), "t")]
    docs = edge_docs(spark, rows)
    assert answer(suffix_dedup.dedup(docs)) == by_hand(document_order(spark, rows))
    left = suffix_dedup.dedup_rows(docs).toDF(*[f"c{i}" for i in range(len(docs.columns))]).collect()
    assert sorted(r.c1 for r in left if r.c0 == 200) == ["", "", rows[-6][1]]
    assert len(left) == len(rows)


def test_rows_of_one_id_are_told_apart_whatever_their_hash(spark):
    """Different texts whose 32-bit hashes are equal, without an id."""
    hashed = spark.range(300_000).select(
        F.concat(F.lit("item "), F.col("id").cast("string"), F.lit(" "), F.sha2(F.col("id").cast("string"), 512)).alias("t")
    )
    found = hashed.groupBy(F.hash("t")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").collect()
    assert found
    texts = [t for r in found for t in r.ts]
    got = answer(suffix_dedup.dedup(edge_docs(spark, [(None, t, "s") for t in texts])))
    assert got == sorted(
        ((None, len(t), 0, 0, hashlib.sha256(t.encode()).hexdigest()) for t in texts), key=repr
    )
    cut = suffix_dedup.dedup_rows(edge_docs(spark, [(None, t, t[:12]) for t in texts]))
    assert sorted((r[1], r[2]) for r in cut.collect()) == sorted((t, t[:12]) for t in texts)


def test_a_phrase_of_many_texts_fills_no_bin(spark, monkeypatch):
    """Segments around one phrase, all different, meet in no group larger than some bins."""
    monkeypatch.setattr(suffix_dedup, "BIN_BYTES", 3000)
    compare = suffix_dedup.repeated_spans

    def bounded(table):
        size = sum(map(len, table["piece"].to_pylist()))
        if size > 30_000:
            raise ValueError(f"{size} bytes in one group")
        return compare(table)

    monkeypatch.setattr(suffix_dedup, "repeated_spans", bounded)
    phrase = "-- all rights in this notice are reserved, see the file of the same name for more --"
    rng = random.Random(6)
    left = ["".join(rng.choices("abcdefghij", k=150)) for _ in range(400)]
    right = ["".join(rng.choices("klmnopqrst", k=150)) for _ in range(400)]
    # Some share the neighbours on one side as well.
    rows = [(i, left[i % 370] + phrase + right[i % 390 if i < 395 else i], "s") for i in range(400)]
    assert answer(suffix_dedup.dedup(edge_docs(spark, rows))) == by_hand([r[:2] for r in rows])


@pytest.mark.parametrize("seed", range(20))
def test_matching_does_not_depend_on_batches(seed):
    rng = np.random.default_rng(seed)
    n = 60
    h, g = np.sort(rng.integers(0, 12, n)), rng.integers(0, 3, n)
    order = np.lexsort((g, h))
    columns = [np.zeros(n, np.int32), h[order], g[order], np.arange(n), np.zeros(n, np.int32), rng.integers(1, 60, n).astype(np.int32)]
    whole = suffix_dedup._record(suffix_dedup.SEGMENT_KINDS, suffix_dedup.SEGMENTS, columns)
    groups = {}
    for x in whole.to_pylist():
        groups.setdefault(x["h"], {}).setdefault(x["g"], []).append(x)
    want = []
    for key, by_digest in groups.items():
        want += [(1, key, x["rid"]) for rows in by_digest.values() for x in rows[1:]]
        if len(by_digest) > 1:
            want += [(0, key, rows[0]["rid"]) for rows in by_digest.values()]
        if sum(rows[0]["windows"] + 100 for rows in by_digest.values()) > 280:
            want.append((2, key, 0))
    for step in (1, 2, 7, 60):
        got = suffix_dedup.matched_segments(280)(iter([whole.slice(at, step) for at in range(0, n, step)]))
        assert sorted((x["kind"], x["h"], x["rid"]) for b in got for x in b.to_pylist()) == sorted(want)


def test_empty(spark):
    docs = edge_docs(spark).limit(0)
    assert suffix_dedup.dedup(docs).count() == 0
    assert suffix_dedup.dedup_rows(docs).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_reference_sql(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert oracle.differences(suffix_dedup.dedup(docs), oracle.connect(folder), oracles.REPEATED_BYTES) == []
