"""Exact search against a comparison of every query with every row."""

import numpy as np
import oracle
import pytest
from vector_cases import awkward, frame, random_rows, whole

from lapwise.llm import oracles, pivot_search, registry, vector_blocks


def brute(rows, step, k):
    out = []
    matrix = np.array([x for _, x, _ in rows], object)
    ids = [i for i, _, _ in rows]
    copies = {}
    for place, (i, x, _) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[1][1])):
        if i % step:
            continue
        copies[i] = copies.get(i, 0) + 1
        scores = matrix @ np.array(x, object)
        order = sorted((p for p in range(len(rows)) if p != place), key=lambda p: (-scores[p], ids[p]))
        out += [(i, r + 1, ids[p], scores[p], copies[i]) for r, p in enumerate(order[:k])]
    return sorted(out)


def found(frame_, **options):
    return sorted(tuple(r) for r in pivot_search.search(frame_, **options).collect())


@pytest.mark.parametrize("size", [3, 24])
def test_edge_rows_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 70)
    monkeypatch.setattr(pivot_search, "CHUNK_QUERIES", 9)
    monkeypatch.setattr(vector_blocks, "SUMMARY_ROWS", 2)
    monkeypatch.setattr(pivot_search, "HOME_ROWS", 100)
    rows = random_rows(size, 300, size, groups=6) + awkward(size)
    got = found(frame(spark, rows), query_step=10, k=5)
    assert got == brute(whole(rows, size), 10, 5)


def test_fewer_candidates_than_asked(spark):
    rows = [(i, [float(i), 1.0], 0) for i in range(4)]
    assert found(frame(spark, rows), query_step=1, k=9) == brute(whole(rows, 2), 1, 9)


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**21 + i, -(2.0**22) - 3 * i, 1.0], 0) for i in range(12)]
    schema = "vec_id long, embedding array<double>, label int, EMBEDDING string, x array<int>, ids string, block long, score int"
    assert found(frame(spark, rows, schema), query_step=5) == brute(whole(rows, 3), 5, 5)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(50, [1.0], 0)]])
def test_nothing_to_find(spark, rows):
    out = pivot_search.search(frame(spark, rows))
    assert out.columns == ["query_id", "rank", "vec_id", "score", "copy"] and out.collect() == []


def test_most_candidates_are_never_evaluated():
    """Rows in distant groups: a query's own group fills its list, and bounds rule out the rest."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16)) * 400
    rows = np.floor(centres[np.arange(2000) % 20] + rng.normal(size=(2000, 16)) * 5)
    table = pivot_search.spread_out(rows, 32)
    far = pivot_search.pivot_table(rows, table)
    query = rows[:1]
    scores = rows @ query[0]
    apart = np.abs(far - far[0]).max(1)[None]
    bounds = pivot_search.score_bounds(far[:1, 0], far[:, 0], apart)[0]
    assert (bounds >= scores).all()
    assert (bounds >= np.sort(scores)[-6]).sum() < 300


def test_registered_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    out = registry.QUERIES["op12_pivot_search"](spark, folder)
    assert oracle.differences(out, oracle.connect(folder), oracles.HIGHEST_PRODUCTS) == []
