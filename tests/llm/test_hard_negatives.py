"""Hard negatives against a comparison of every anchor with every row."""

import numpy as np
import oracle
import pytest
from vector_cases import awkward, frame, random_rows, whole

from lapwise.llm import hard_negatives, oracles, registry, vector_blocks


def brute(rows, step, positives, negatives, relabel=lambda i, label: label):
    rows = [(i, x, relabel(i, label)) for i, x, label in rows]
    matrix = np.array([x for _, x, _ in rows], object)
    out, copies = [], {}
    for place, (i, x, label) in sorted(enumerate(rows), key=lambda r: (r[1][0], r[1][1], r[1][2])):
        if i % step:
            continue
        copies[i] = copies.get(i, 0) + 1
        scores = matrix @ np.array(x, object)
        order = sorted((p for p in range(len(rows)) if p != place), key=lambda p: (-scores[p], rows[p][0]))
        near = [p for p in order if rows[p][2] == label][:positives]
        for nth, p in enumerate(near, 1):
            fitting = [
                o for o in order
                if rows[o][2] != label and 30 * scores[p] <= 100 * scores[o] <= 90 * scores[p]
            ]
            out += [
                (i, rows[p][0], r, rows[o][0], scores[p], scores[o], copies[i], nth)
                for r, o in enumerate(fitting[:negatives], 1)
            ]
    return sorted(out)


def mined(frame_, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(frame_, **options).collect())


def moved(i, label):
    return (label + 1) % 10 if i % 7 == 0 else label


@pytest.mark.parametrize("size", [3, 24])
def test_edge_rows_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 70)
    monkeypatch.setattr(hard_negatives, "CLUSTER_ANCHORS", 7)
    monkeypatch.setattr(hard_negatives, "STEP", 16)
    monkeypatch.setattr(vector_blocks, "SUMMARY_ROWS", 2)
    monkeypatch.setattr(hard_negatives, "HOME_ROWS", 100)
    from pyspark.sql import functions as F

    rows = random_rows(size + 1, 400, size, groups=6) + awkward(size)
    got = mined(
        frame(spark, rows), anchor_step=20,
        relabel=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label),
    )
    want = brute(whole([r for r in rows if r[2] is not None], size), 20, 5, 10, moved)
    assert want and got == want


def test_few_rows_and_ties(spark):
    rows = [(i, [1.0, float(i % 2)], i % 2) for i in range(9)]
    assert mined(frame(spark, rows), anchor_step=1) == brute(whole(rows, 2), 1, 5, 10)


def test_list_ends_before_all_rows_are_read():
    """A member in a tight cluster stops once the bound is below what it still needs."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    rows = np.floor(256 * (centres[np.arange(3000) % 30] + rng.normal(size=(3000, 16)) * 0.02))
    unit, norms = hard_negatives.units(rows)
    centre, radius = hard_negatives.middle(unit[::300], norms[::300])
    bounds = hard_negatives.widest(norms, hard_negatives.angles(unit, centre) - radius)
    for member in rows[::300]:
        scores = rows @ member
        assert (np.linalg.norm(member) * bounds >= scores - 1e-6 * np.abs(scores)).all()
        assert (np.linalg.norm(member) * bounds >= np.sort(scores)[-6]).sum() < 1000


@pytest.mark.parametrize("rows", [[], [(100, None, 0)], [(100, [1.0], None)], [(100, [1.0], 1)]])
def test_nothing_to_mine(spark, rows):
    out = hard_negatives.mine(frame(spark, rows))
    assert out.columns[:3] == ["anchor_id", "positive_id", "rank"] and out.collect() == []


def test_registered_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    out = registry.QUERIES["op13_hard_negatives"](spark, folder)
    assert oracle.differences(out, oracle.connect(folder), oracles.HARD_NEGATIVES) == []
