import os

import numpy as np
import pytest

from lapwise.llm import curve_neighbours


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2.0) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, before long, curve double").repartition(3)


def exact(ids, vectors, step, k):
    ids, x = np.array(ids), np.array(vectors, float)
    out = {}
    for q in np.flatnonzero(ids % step == 0):
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), score[i]) for i in order]
    return out


def answer(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in out.items()}


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = curve_neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_ties_copies_and_lengths_exactly(spark):
    """Within one block the search is exact, copies and ties included."""
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(300, 6)), 1)
    x[50:200] = x[40]
    ids = list(range(1, 301))
    got = answer(curve_neighbours.search(frame(spark, ids, x), 20, 20))
    want = exact(ids, x, 20, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_what_takes_no_part(spark):
    vectors = [[1, 2], None, [0, 0], [float("nan"), 1], [1, None], [float("inf"), 1], [], [3, 1], [2, 2], [1, 1, 1]]
    ids = [20, 40, 60, 80, 100, 120, 140, 3, None, 160]
    got = answer(curve_neighbours.search(frame(spark, ids, vectors)))
    assert got == {20: [(3, 5.0)]}


def test_norms_decide_too(spark):
    """Recall against brute force over many blocks, with norms that differ tenfold."""
    rng = np.random.default_rng(3)
    n = 4000
    x = rng.normal(size=(n, 32)) * rng.uniform(0.3, 3, n)[:, None]
    ids = list(range(n))
    old = curve_neighbours.BLOCK_ROWS
    curve_neighbours.BLOCK_ROWS = 100
    try:
        got = answer(curve_neighbours.search(frame(spark, ids, x), 20, 20))
    finally:
        curve_neighbours.BLOCK_ROWS = old
    want = exact(ids, x, 20, 20)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    assert all(len(rows) == 20 for rows in got.values())


@pytest.mark.parametrize("tail", ["one long", "heavy", "huge"])
def test_long_vectors_do_not_crowd_the_others(spark, monkeypatch, tail):
    """Recall on groups of near vectors when some norms are far greater than the rest."""
    rng = np.random.default_rng(5)
    n = 6000
    x = (rng.normal(size=(n // 20, 32))[:, None] + 0.2 * rng.normal(size=(n // 20, 20, 32))).reshape(n, 32)
    if tail == "heavy":
        x *= (1 + rng.pareto(0.7, n))[:, None]
    else:
        x[7] *= 1e4 if tail == "one long" else 1e200
    monkeypatch.setattr(curve_neighbours, "BLOCK_ROWS", 50)
    ids = list(range(n))
    reach = 0.02 if tail == "heavy" else None
    got = answer(curve_neighbours.search(frame(spark, ids, x), 20, 20, reach))
    want = exact(ids, x, 20, 20)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9


def without_structure(size, norms, n=6000):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(n, size))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x * {"one": 1.0, "start": 2.1, "end": 7.8, "band": 2.0 ** rng.uniform(1, 3, n)[:, None]}[norms]


def met(x, asked, block):
    """Rows that each query meets on all curves, from the operator's own placement."""
    n, size = x.shape
    norms = np.linalg.norm(x, axis=1)
    bands = np.floor((np.log2(norms) + 1) / 2).astype(int)
    assert len(set(bands)) == 1
    length, grids = curve_neighbours.fitted(x[: curve_neighbours.FIT_ROWS], bands[: curve_neighbours.FIT_ROWS], 4)
    index = curve_neighbours.scaled(x, bands)
    query = np.hstack([length * x[asked] / norms[asked][:, None], np.full((len(asked), 1), np.sqrt(1 - length**2))])
    reach = curve_neighbours.REACH * max(1.0, size / 64) ** curve_neighbours.REACH_GROWTH
    blocks = -(-n // block)
    width = min(blocks, int(np.ceil(reach * blocks)) + 1)
    seen = [set() for _ in asked]
    bits = curve_neighbours.GRID_BITS
    for (matrix, shift), (low, wide) in zip(curve_neighbours.projections(size + 1, 4), grids):
        keys = [
            curve_neighbours.hilbert_keys(
                np.clip(((p @ matrix - low) / wide / 2 + shift / 2) * (1 << bits), 0, (1 << bits) - 1), bits
            )
            for p in (index, query)
        ]
        order = np.argsort(keys[0], kind="stable")
        place = np.searchsorted(keys[0][order], keys[1]) // block
        begin = np.clip(place - width // 2, 0, blocks - width)
        for s, at in zip(seen, begin):
            s.update(order[at * block : (at + width) * block].tolist())
    return seen


@pytest.mark.parametrize("size", [64, 256, 768])
@pytest.mark.parametrize("norms", ["one", "start", "end", "band"])
def test_recall_without_structure(size, norms):
    """Random directions, 120 blocks, norms at 1, at either end of a band and over all of it."""
    x = without_structure(size, norms)
    asked = np.arange(0, len(x), 50)
    want = exact(range(len(x)), x, 50, 20)
    found = met(x, asked, 50)
    recall = [len(s & {i for i, _ in want[q]}) / 20 for q, s in zip(asked.tolist(), found)]
    assert np.mean(recall) >= 0.95


def test_the_query_meets_what_the_placement_says(spark, monkeypatch):
    """The same recall through Spark, unit vectors of 64 dimensions."""
    x = without_structure(64, "one", 3000)
    monkeypatch.setattr(curve_neighbours, "BLOCK_ROWS", 30)
    got = answer(curve_neighbours.search(frame(spark, range(len(x)), x), 100, 20))
    want = exact(range(len(x)), x, 100, 20)
    recall = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.95


def test_rows_of_one_id_stay_apart(spark):
    vectors = [[1, 0], [0, 1], [2, 1], [3, 5], [1, 0], [1, 0]]
    ids = [20, 20, 3, 3, 20, 7]
    found = curve_neighbours.search(frame(spark, ids, vectors)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.copy, r["rank"])):
        got.setdefault(r.copy, []).append((r.vec_id, r.score))
    # Copies of 20: [0, 1] first, then the two equal rows.
    assert got[1] == [(3, 5.0), (3, 1.0), (7, 0.0), (20, 0.0), (20, 0.0)]
    assert got[2] == got[3] == [(3, 3.0), (3, 2.0), (7, 1.0), (20, 1.0), (20, 0.0)]


def test_recall_on_the_test_table(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test data")
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = vectors.collect()
    old = curve_neighbours.BLOCK_ROWS
    curve_neighbours.BLOCK_ROWS = 64
    try:
        got = answer(curve_neighbours.search(vectors))
    finally:
        curve_neighbours.BLOCK_ROWS = old
    want = exact([r.vec_id for r in rows], [r.embedding for r in rows], 20, 20)
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9


def test_empty(spark):
    assert curve_neighbours.search(frame(spark, [1], [[1.0]]).limit(0)).count() == 0
    assert curve_neighbours.search(frame(spark, [20], [[1.0]])).count() == 0


def scratch(spark):
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/lapwise"
    return {n for n in os.listdir(folder) if n.startswith("curve-")} if os.path.isdir(folder) else set()


def test_curve_by_curve_and_in_shares_is_the_same_search(spark, monkeypatch):
    """All curves at once, one after the other, spans shared out: equal rows, and only the last ones stay on disk."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 8)).astype(np.float32)
    x[::40] = x[0]
    vectors = spark.createDataFrame(
        [(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>").repartition(3)
    monkeypatch.setattr(curve_neighbours, "BLOCK_ROWS", 40)

    def found():
        return sorted(map(tuple, curve_neighbours.search(vectors, 10, 5, 0.05).collect()))

    want = found()
    assert len(want) == 150 * 5
    before = scratch(spark)
    monkeypatch.setattr(curve_neighbours, "PASS_ROWS", 1500 * 6)
    assert found() == want
    left = scratch(spark) - before
    assert len(left) == 1 and left.pop().startswith("curve-best")
    monkeypatch.setattr(curve_neighbours, "CHUNK_QUERIES", 4)
    monkeypatch.setattr(curve_neighbours, "UNEVEN", 0)
    assert found() == want


def test_a_class_is_shuffled_once_a_curve_and_a_query_a_few_times():
    """The numbers do not grow with the blocks that a query meets."""
    for blocks, width in ((50, 6), (500, 51), (5000, 501)):
        begins = np.zeros(blocks, [("key", np.int64), ("mark", np.int64)])
        curve = curve_neighbours.Blocks(begins, width, -(-width // 2))
        own, asks = np.arange(blocks).repeat(2), np.tile([False, True], blocks)
        begin, who, span = curve.spans(own, asks)
        assert (np.bincount(who)[~asks] == 1).all() and np.bincount(who)[asks].max() <= 3
        for q in np.flatnonzero(asks)[:: blocks // 50]:
            met = range(begin[q], begin[q] + width)
            assert own[q] in met and set(span[who == q]) == {b // curve.span for b in met}


def test_places_with_equal_keys_are_told_apart_by_their_marks():
    begins = np.array([(0, 5), (7, -3), (7, 2), (7, 9), (8, 0)], [("key", np.int64), ("mark", np.int64)])
    curve = curve_neighbours.Blocks(begins, 1, 1)
    places = [(0, 1), (0, 5), (6, 9), (7, -4), (7, -3), (7, 8), (7, 9), (8, -1), (8, 0), (9, 0)]
    key, mark = np.array(places).T
    assert curve.own(key, mark).tolist() == [0, 0, 0, 0, 1, 2, 3, 3, 4, 4]
