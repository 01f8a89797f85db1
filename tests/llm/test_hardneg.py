import math

import numpy as np
import pytest

from quarry.llm import hardneg


def vectors(n, dims, labels=4, seed=5):
    """Clustered points with ties, copies, zero vectors, and a vector that a third of the rows share."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dims)) * 0.3 + rng.normal(size=(5, dims))[rng.integers(0, 5, size=n)]
    points[::3] = points[0]
    points[7::50] = 0
    return [(i, points[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


def brute(rows, every=50):
    rows = [(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in rows]
    out = []
    for a, x, own in sorted({r for r in rows if r[0] % every == 0}):
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, label) for i, v, label in rows if i != a and len(v) == len(x))
        for s, i, _ in [r for r in scored if r[2] == own][:5]:
            fits = [(n, j) for n, j, label in scored if label != own and 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a, i, r + 1, j, -s, -n) for r, (n, j) in enumerate(fits)]
    return sorted(out)


def mined(rows, spark, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, rank string, key int").repartition(5)
    return sorted(map(tuple, hardneg.hard_negatives(df, **more).collect()))


def test_equals_brute_force(spark):
    rows = vectors(1200, 6) + [(5000 + 10 * i, v, label) for i, v, label in vectors(60, 3, seed=8)]
    bad = [(6000, None, 1), (6050, [], 1), (6100, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (6150, [float("nan")] * 6, 1), (6200, [float("inf")] * 6, 1),
           (6250, [1.0] * 6, None), (None, [1.0] * 6, 1), (6300, [1e10] * 6, 1)]
    want = brute(rows)
    assert len(want) > 100
    assert mined(rows + bad, spark) == want
    assert mined(rows, spark, shard_rows=100, block_rows=3) == want


def test_repeated_rows(spark):
    rows = vectors(300, 4)
    rows += [rows[50]] * 3 + [rows[9]] * 40 + [(100, [0.5, 0.5, 0.5, 0.5], 2), (100, rows[100][1], 3)]
    assert mined(rows, spark, shard_rows=64) == brute(rows)


def test_few_rows(spark):
    assert mined([], spark) == []
    assert mined([(0, [1.0], 1)], spark) == []
    assert mined([(0, [1.0], 1), (1, [1.0], 1), (2, [0.6], 2), (3, [0.99], 2)], spark) == [(0, 1, 1, 2, 65536, 39168)]
    assert mined([(0, [1.0], 1), (1, [-1.0], 1), (2, [0.6], 2)], spark) == []      # a negative positive score: no window


@pytest.mark.parametrize("shift", [0, 18, 20])
def test_exact_however_large(spark, shift):
    """Scores beyond what doubles hold exactly."""
    rows = [(i, [x * 2.0 ** shift for x in v], label) for i, v, label in vectors(200, 2)]
    assert (max((r[5] for r in brute(rows)), default=0) > 1 << 53) == (shift > 0)
    assert mined(rows, spark) == brute(rows)


def test_siblings_are_left_out():
    """In clustered data most points are never compared, and the result is that of all pairs."""
    rng = np.random.default_rng(2)
    points = (rng.normal(size=(12, 8)) * 400)[rng.integers(0, 12, size=6000)] + rng.normal(size=(6000, 8)) * 20
    points = np.floor(points).astype(np.int64)
    ids, labels = np.arange(6000), rng.integers(0, 3, size=6000)
    tree = hardneg.Tree(points, ids, labels)
    q = np.arange(0, 6000, 50)
    found = hardneg.Search(tree, points[q], ids[q], labels[q], np.arange(len(q)), np.full(len(q), hardneg.LEAST), np.full(len(q), hardneg.MOST), 5, True)
    scores = points[q] @ points.T
    for i, a in enumerate(q):
        fits = np.flatnonzero((labels == labels[a]) & (ids != a))
        best = sorted(zip((-scores[i, fits]).tolist(), fits.tolist()))[:5]
        assert [(-s, j) for s, j in zip(found.best[i].tolist(), found.best_id[i].tolist())] == best
    assert found.scored < 0.5 * len(q) * 6000
    packed = {name: getattr(tree, name) for name in hardneg.Tree.FIELDS}
    again = hardneg.Tree(**hardneg._unpacked(hardneg._packed(**packed)))
    more = hardneg.Search(again, points[q], ids[q], labels[q], np.arange(len(q)), np.full(len(q), hardneg.LEAST), np.full(len(q), hardneg.MOST), 5, True)
    assert (more.best == found.best).all() and (more.best_id == found.best_id).all()
