"""Vectors with every awkward case, and the whole-number rows that take part."""

import math

import numpy as np

SCHEMA = "vec_id long, embedding array<float>, label int, EMBEDDING string, x array<int>, ids string, block long, score int"


def frame(spark, rows, schema=SCHEMA):
    full = [(i, v, label, "other", [1], "ids", 2, 3) for i, v, label in rows]
    return spark.createDataFrame(full, schema).repartition(3)


def random_rows(seed, count, size, groups=0, spread=1.0):
    """``(id, vector, label)``; some in tight groups, with copies and repeated ids."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(groups, 1), size))
    rows = []
    for i in range(count):
        v = rng.normal(size=size) * spread
        if groups and i % 2:
            v = centres[i % groups] + 0.05 * v
        norm = np.linalg.norm(v) if i % 3 else 1.0
        rows.append((i, [float(c) for c in v / norm], int(rng.integers(0, 10))))
    for i in range(0, count // 5, 2):
        rows.append((count + i, rows[i][1], rows[i][2]))
    return rows


def awkward(size):
    one = [1.0] * size
    return [
        (500, None, 1), (501, [], 1), (502, [None] + one[1:], 2), (503, [float("nan")] * size, 3),
        (504, [float("-inf")] + one[1:], 4), (505, [1.0, 2.0], 5), (None, one, 6), (600, one, None),
        (601, [3e38] * size, 1), (700, [0.0] * size, 2), (701, [0.0] * size, 2), (702, [0.0] * size, 3),
        (800, [0.25] * size, 4), (800, [0.25] * size, 4), (800, [0.5] * size, 4), (800, one, 5),
    ]


def whole(rows, size, scale=256):
    limit = math.isqrt((2**63 - 1) // size) - 1
    out = []
    for i, v, label in rows:
        if i is None or not v or len(v) != size or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(scale * float(np.float32(c))) for c in v]
        if max(map(abs, x)) <= limit:
            out.append((i, x, label))
    return out
