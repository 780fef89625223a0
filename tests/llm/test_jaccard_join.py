import os
import random
from itertools import combinations

import numpy as np
import oracle
import pytest
from cases import edge_docs, edge_rows, prose

from lapwise.llm import common, jaccard_join, oracles


def gram_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def by_hand(rows):
    sets = [gram_set(t) for _, t, *_ in rows]
    parent, degree = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            degree[i] += 1
            degree[j] += 1
            parent[find(i)] = find(j)
    out = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        smallest = row[0] if not sets[i] else min(ids, default=None)
        out.append((row[0], len(sets[i]), smallest, degree[i]))
    return sorted(out, key=repr)


def answer(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_against_all_pairs(spark):
    assert answer(jaccard_join.join(edge_docs(spark))) == by_hand(edge_rows())


def variants(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def test_chains_borders_and_common_passages(spark, monkeypatch):
    """Links at the border of 80 %, chains of variants, blocks far smaller than the groups."""
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", 7)
    monkeypatch.setattr(jaccard_join, "BLOCK_COLUMNS", 32)
    rng = random.Random(3)
    base, common = prose(11, 90), prose(12, 25)
    rows = [(i, variants(rng, base, rng.randrange(6)), "s") for i in range(40)]
    drift = prose(13, 80)
    for i in range(12):
        drift = variants(rng, drift, 2)
        rows.append((100 + i, drift, "s"))
    rows += [(200 + i, f"{prose(300 + i, 20 + i)} {common}", "s") for i in range(30)]
    rows += [(300 + i, " ".join(f"v{k}" for k in range(i, i + 44)), "s") for i in range(8)]
    rows += [(400 + i, f"{i % 3} b c", "s") for i in range(9)]
    assert answer(jaccard_join.join(edge_docs(spark, rows))) == by_hand(rows)


def test_overlaps_equal_set_counts(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_COLUMNS", 5)
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40))) for _ in range(12)]
    expected = [[len(set(a) & set(b)) for b in sets] for a in sets]
    assert jaccard_join.overlaps(sets).astype(int).tolist() == expected


def test_one_of_each_group_stays(spark):
    docs = edge_docs(spark)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    names = [f"c{i}" for i in range(len(docs.columns))]
    got = [(r.c0, r.c1) for r in kept.toDF(*names).collect()]
    ids = [d for d, _ in got]
    assert 0 in ids and not {1, 2} & set(ids)
    # Rows of one id with different texts are judged apart; equal rows leave one.
    assert ids.count(7) == 2 and ids.count(8) == 1
    assert sum(t is None or not t.strip() for _, t in got) == 3
    assert all(100 + i in ids for i in range(60))


def test_empty(spark):
    docs = edge_docs(spark).limit(0)
    assert jaccard_join.join(docs).count() == 0
    assert jaccard_join.keep_one(docs).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_reference_sql(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert oracle.differences(jaccard_join.join(docs), oracle.connect(folder), oracles.JACCARD_LINKS) == []


def test_copies_alone_are_not_read_again(spark, monkeypatch):
    """Sets that are shared by copies only do not pass the sieve, and those left are read once."""
    rows = {}

    def counted(df, label):
        out = stored(df, label)
        rows[label] = out.count()
        return out

    stored = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", counted)
    texts = [" ".join(f"t{i}w{j}" for j in range(60)) for i in range(20)]
    near = texts[0] + " more"
    docs = [(i, t) for i, t in enumerate(texts * 3)] + [(900, near), (900, near), (None, near)]
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    assert answer(jaccard_join.join(frame)) == by_hand(docs)
    assert rows["gram-sets"] == 2


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_grams_are_shuffled_once(spark, monkeypatch):
    """Neither the sieve nor the sets left shuffle their grams a second time to count them."""
    plans = {}

    def planned(df, label):
        plans[label] = plan_of(df)
        return stored(df, label)

    stored = jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", planned)
    jaccard_join.join(edge_docs(spark)).count()
    by_gram = [plan.count("Exchange hashpartitioning(gram#") for plan in plans.values()]
    assert sum(by_gram) == 2 and max(by_gram) == 1


def test_rows_marked_in_vain(spark, monkeypatch):
    """A full map marks every row and changes nothing."""
    docs = edge_docs(spark)

    def kept():
        rows = jaccard_join.keep_one(docs).toDF(*[f"c{i}" for i in range(len(docs.columns))])
        return sorted(map(repr, rows.select("c0", "c1").collect()))

    expected = kept()
    monkeypatch.setattr(common, "MAP_BITS", 1)
    assert kept() == expected


def test_marked_misses_no_hash(spark):
    hashes = [(h,) for h in (0, -1, 7, 8, 2**15 - 1, 2**15, -(2**63), 2**63 - 1, 123456789)]
    rows = spark.createDataFrame([*hashes, (9,), (1 << 20,)], "h long")
    found = common.marked(rows, "h", spark.createDataFrame(hashes, "h long"))
    assert found.columns == ["h", "marked"]
    assert {r.h for r in found.where("marked").collect()} == {h for h, in hashes}
