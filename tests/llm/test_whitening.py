import math

import numpy as np
import pytest

from quarry.llm import whitening


def brute(rows, k=32):
    """{(vec_id, component): (deviation, |whitened|, explained)} by NumPy's own solver and Python's integers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(col) for col in zip(*x)]
    z = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, parts = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:k]
    out = {}
    for (i, _), own, row in zip(rows, z, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        for c, o in enumerate(order):
            if values[o] > 1e-9 * values.max():
                out[i, c + 1] = (deviation, abs(own @ parts[:, o]) / math.sqrt(values[o]), values[o] / values.sum())
    return out


def check(got, want, n):
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        deviation, size, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - size) < 1e-6 * (1 + size) and abs(r.explained - explained) < 1e-9
        assert 0 <= r.identity_error < 1e-9


def vectors(n, d, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) * np.linspace(3, 0.5, d) @ rng.normal(size=(d, d))
    return [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]


def test_equals_brute_force(spark):
    rows = vectors(400, 40)
    bad = [(900, None), (901, [1.0, None] * 20), (902, [float("nan")] * 40), (903, [float("-inf")] * 40), (904, []), (905, [1e300] * 40)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows + bad], "vec_id bigint, embedding array<double>, n int, whitened string").repartition(7)
    check(whitening.whiten(df).collect(), brute(rows), 400)


def test_lengths_apart_ties_and_rank(spark):
    long, short = vectors(60, 5), [(100 + i, v) for i, v in vectors(30, 2, 9)]
    flat = [(200 + i, [1.0, 2.0, 3.0]) for i in range(4)]                 # equal rows: no component
    thin = [(300 + i, [float(i), 2.0 * i, 5.0, -float(i)]) for i in range(9)]   # one direction only
    rows = long + short + flat + thin + [(400, [1.0] * 6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)).collect()
    check([r for r in got if r.vec_id < 100], brute(long), 60)
    check([r for r in got if 100 <= r.vec_id < 200], brute(short), 30)
    check([r for r in got if 300 <= r.vec_id < 400], brute(thin), 9)
    assert not [r for r in got if 200 <= r.vec_id < 300 or r.vec_id >= 400]


def test_repeated_rows_and_no_ids(spark):
    rows = vectors(20, 3) + vectors(20, 3)[:5]
    got = whitening.whiten(spark.createDataFrame(rows + [(None, [9.0, 9.0, 9.0])], "vec_id bigint, embedding array<double>")).collect()
    assert len(got) == 26 * 3 and {r.n for r in got} == {26}
    assert sum(r.vec_id is None for r in got) == 3 and sum(r.vec_id == 0 for r in got) == 6


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


@pytest.mark.parametrize("big", [2.0 ** 40, 2.0 ** 55])
def test_large_entries_stay_exact(spark, big):
    rows = [(0, [big, 1.0]), (1, [-big, 2.0]), (2, [big / 2, 4.0]), (3, [0.25, 0.5])]
    got = {r.vec_id: r.deviation for r in whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    want = {i: v[0] if v[0] < 1 << 63 else None for (i, _), v in brute(rows).items()}
    assert got == {i: want[i] for i in got} and len(got) == 4


def test_exact_sums_beyond_64_bits():
    centre = whitening.Centre(10 ** 9, [10 ** 15 + 7, -3])
    x = np.array([[10 ** 6, 0], [10 ** 6 + 40, 5]])
    assert centre.scaled(x).tolist() == [[10 ** 15 - 10 ** 15 - 7, 3], [10 ** 9 * (10 ** 6 + 40) - 10 ** 15 - 7, 5 * 10 ** 9 + 3]]
    assert centre.deviation(x) == [49 + 9, None]


@pytest.mark.parametrize("d", [1, 2, 7, 32, 65])
def test_factor_and_rotations(d):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(3 * d, d)) * np.logspace(0, -5, d)
    v = a.T @ a
    factor = whitening.cholesky(v)
    assert np.abs(factor @ factor.T - v).max() < 1e-12 * v.max()
    values, parts = whitening.jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1], rtol=1e-6, atol=1e-14 * v.max())
    assert np.abs(parts.T @ parts - np.eye(len(values))).max() < 1e-12
