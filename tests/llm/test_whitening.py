"""Whitening against a direct eigendecomposition."""

import math

import numpy as np
import pytest

from lapwise.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, EMBEDDING string, component int, n string, x array<int>"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "other", 3, "n", [1]) for i, v in rows], schema).repartition(3)


def clean(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, np.array([math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v])) for i, v in good]


def expected(rows):
    """Distinct rows, sums, eigenvalues and vectors, by numpy on the exact centred numbers."""
    listed = sorted({tuple(int(c) for c in x) for _, x in rows})
    n = len(listed)
    sums = [sum(c) for c in zip(*listed)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in listed])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, sums, values[::-1], vectors[:, ::-1]


def compare(out, rows, components=16):
    n, sums, values, vectors = expected(rows)
    count = min(components, len(sums), int((values > 1e-12 * values[0]).sum()))
    assert len(out) == len(rows) * count
    by_component = {}
    for r in out:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, count + 1))
    for c, got in by_component.items():
        direct = {}
        for i, x in rows:
            exact = [n * int(a) - s for a, s in zip(x, sums)]
            white = float(np.array(exact) / n @ vectors[:, c - 1]) / math.sqrt(values[c - 1])
            direct.setdefault(i, []).append((sum(e * e for e in exact), white))
        flat = sorted((i is not None, i or 0, d, w) for i, l in direct.items() for d, w in l)
        best = np.inf
        for sign in (1, -1):
            mine = sorted((r.vec_id is not None, r.vec_id or 0, r.deviation, sign * r.whitened) for r in got)
            assert [m[:3] for m in mine] == [f[:3] for f in flat]
            best = min(best, max(abs(m[3] - f[3]) for m, f in zip(mine, flat)))
        assert best < 1e-8
        assert all(r.n == n for r in got)
        assert all(abs(r.explained / (values[c - 1] / values.sum()) - 1) < 1e-9 for r in got)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9


def edge_rows():
    rng = np.random.default_rng(5)
    spread = np.array([5, 3, 2, 1, 0.5, 0.2])
    rows = [(i, [float(c) for c in rng.normal(size=6) * spread]) for i in range(80)]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (None, rows[3][1]), (7, rows[8][1])]
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0, 1.0, 1.0, 1.0]), (93, [float("nan")] * 6),
           (94, [float("inf")] + [0.0] * 5), (95, [1.0, 2.0]), (96, [3e38] * 6)]
    return rows, bad


def test_edge_rows_against_numpy(spark):
    rows, bad = edge_rows()
    out = whitening.whiten(frame(spark, rows + bad)).collect()
    compare(out, clean(rows))


@pytest.mark.parametrize("size", [40, 70])
def test_filtered_subspace_against_numpy(spark, size):
    """More dimensions than the basis holds, with a spectrum almost without gaps."""
    rng = np.random.default_rng(size)
    rows = [(i, [float(c) for c in rng.normal(size=size)]) for i in range(400)]
    out = whitening.whiten(frame(spark, rows)).collect()
    compare(out, clean(rows))


def test_missed_direction_is_found():
    """The first basis lies across an eigenvector; the fresh columns bring it up."""
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(60, 60)))[0]
    values = np.r_[50.0, np.linspace(10, 9, 19), np.linspace(5, 1, 40)]
    matrix = turn @ np.diag(values) @ turn.T
    got, vectors = whitening.leading(lambda q: matrix @ q, 60, 16, 8, 10, 3)
    assert np.allclose(got, values[:16], rtol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-11


def test_repeated_eigenvalues_end():
    matrix = np.diag(np.r_[np.full(20, 4.0), np.full(40, 1.0)])
    got, vectors = whitening.leading(lambda q: matrix @ q, 60, 16, 8, 10, 3)
    assert np.allclose(got, 4.0) and np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-10)


def test_low_rank_leaves_components_out(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(-20, 20, size=(60, 2))
    rows = [(i, [float(v) for v in [a, b, a + b, 0, a - b]]) for i, (a, b) in enumerate(base)]
    out = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in out} == {1, 2}
    compare(out, clean(rows))


def test_large_numbers_are_exact(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**40 + 2.0**20, 5.0]), (2, [2.0**30, 9.0])]
    schema = SCHEMA.replace("array<float>", "array<double>")
    out = whitening.whiten(frame(spark, rows, schema)).collect()
    xs = {i: [math.floor(64 * c) + 1_000_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*xs.values())]
    for r in out:
        exact = sum((3 * a - s) ** 2 for a, s in zip(xs[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.whiten(frame(spark, rows))
    assert out.columns == [c.split()[0] for c in whitening.RESULT.split(", ")] and out.collect() == []
