import os
import zlib
from collections import defaultdict

import oracle
import pytest
from cases import edge_docs, edge_rows

from lapwise.llm import oracles, sharding

FOLDER = "/root/testdata/sf0.001"


def test_sizes_checksums_and_slots(spark):
    got = sharding.shard_by_bytes(edge_docs(spark), shards=7).collect()
    texts = [(d, (t or "").encode()) for d, t, _ in edge_rows()]
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (repr(d), len(b) + 16, zlib.crc32(b)) for d, b in texts
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(0 <= r.shard < 7 and r.law == "bytes" and r.grown_shard is None for r in got)


def test_near_equal_with_a_large_group(spark):
    rows = [(i, "copy of one text " * 4, "s") for i in range(400)]
    rows += [(1000 + i, f"text number {i} " * 5, "s") for i in range(800)]
    got = sharding.shard_by_bytes(edge_docs(spark, rows), shards=10).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 10
    assert len(sizes) == 10 and all(abs(s - mean) < 0.1 * mean for s in sizes.values())


def test_small_groups_stay_together(spark):
    rows = [(i, f"text number {i // 4} and some more words", "s") for i in range(2000)]
    got = sharding.shard_by_bytes(edge_docs(spark, rows), shards=5).collect()
    shards = defaultdict(set)
    for r in got:
        shards[r.doc_id // 4].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())


def test_main_path_runs_no_python(spark):
    plan = sharding.shard_by_bytes(edge_docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert sharding.shard_by_bytes(edge_docs(spark).limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_reference_sql(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert oracle.differences(sharding.shard_by_bytes(docs), oracle.connect(FOLDER), oracles.SHARDS) == []
