from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import edge_docs, edge_rows, words

from lapwise.llm import mixing


def targets_by_hand(rows):
    """Excess over three times a source goes to the others by weight, again and again."""
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    sources = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in sources if s not in capped]
        target = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            return sizes, {**{s: 3.0 * sizes[s] for s in capped}, **target}
        capped |= over


def many_rows():
    rng = np.random.default_rng(1)
    shares = {"b": 900, "a": 40, None: 300, "é": 500, "z": 12, "c": 700}
    rows, i = [], 0
    for source, n in shares.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * int(rng.integers(1, 300))), source))
            i += 1
    return rows


def test_targets_counts_and_bounds(spark):
    rows = many_rows()
    sizes, target = targets_by_hand(rows)
    source = {d: s for d, _, s in rows}
    got = mixing.mix(edge_docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.size) for r in got) == sorted((d, len(words(t))) for d, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]], rel=1e-9)
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert taken[s] == pytest.approx(target[s], rel=0.01)


def test_blocks_merge_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 20)
    monkeypatch.setattr(mixing, "BLOCKS_MERGED", 4)
    rows = many_rows()
    _, target = targets_by_hand(rows)
    source = {d: s for d, _, s in rows}
    taken = defaultdict(int)
    for r in mixing.mix(edge_docs(spark, rows)).collect():
        taken[source[r.doc_id]] += r.taken
    for s, wanted in target.items():
        assert taken[s] == pytest.approx(wanted, rel=0.01)


def test_reruns_and_partitioning_agree(spark):
    docs = edge_docs(spark, many_rows())
    first = Counter(map(tuple, mixing.mix(docs).collect()))
    assert first == Counter(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    assert first != Counter(map(tuple, mixing.mix(docs, seed=9).collect()))


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(0, 200))
        pi, size = np.full(n, rng.random()), rng.integers(0, 50, n)
        moved = mixing.flight(pi, size, rng)
        assert ((moved > 0) & (moved < 1)).sum() <= 2
        assert moved.sum() == pytest.approx(pi.sum(), abs=1e-6)
        assert (moved * size).sum() == pytest.approx((pi * size).sum(), abs=1e-4)


@pytest.mark.parametrize("fraction", [5e-10, 1 - 5e-10, 1e-12])
def test_tiny_fractions_close(spark, fraction):
    size = np.arange(1, 41)
    moved = mixing.flight(np.full(40, fraction), size, np.random.default_rng(1))
    assert mixing.is_open(moved).sum() <= 2
    assert moved.sum() == pytest.approx(40 * fraction, rel=1e-6)
    rows = [(0, 0, i, i, 1, int(s), 0, fraction, 10, 1.0) for i, s in enumerate(size)]
    decided = mixing.cube(spark.createDataFrame(rows, mixing.UNIT), 5).collect()
    assert len(decided) == 40 and all(r.pi in (0.0, 1.0) for r in decided)


def test_inclusion_follows_the_probability():
    size = np.arange(1, 41)
    counts = sum(
        mixing.landing(mixing.flight(np.full(40, 0.3), size, np.random.default_rng(s)), size)
        for s in range(400)
    )
    assert abs(counts / 400 - 0.3).max() < 0.12


def test_edges(spark):
    rows = edge_rows()
    sizes, target = targets_by_hand(rows)
    got = mixing.mix(edge_docs(spark)).collect()
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted(
        (repr(d), len(words(t))) for d, t, _ in rows
    )
    by_size = defaultdict(set)
    for s, n in sizes.items():
        by_size[n].add(round(target[s], 6))
    assert all(round(r.target, 6) in by_size[r.source_size] for r in got)
    assert mixing.mix(edge_docs(spark).limit(0)).count() == 0
    assert mixing.mixed_rows(edge_docs(spark).limit(0)).count() == 0


def test_rows_are_repeated_as_drawn(spark):
    docs = edge_docs(spark)
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    names = [f"c{i}" for i in range(len(docs.columns))]
    got = Counter((r.c0, r.c1, r.c2) for r in out.toDF(*names).collect())
    assert set(got) <= set(edge_rows())
    sizes, target = targets_by_hand(edge_rows())
    taken = defaultdict(int)
    for (_, text, source), n in got.items():
        taken[source] += n * len(words(text))
    assert taken["src0"] == pytest.approx(target["src0"], rel=0.05)
