"""Order-independent sums against exact rational arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import exactsum


def values(seed, n):
    pick = random.Random(seed)
    return [math.ldexp(pick.uniform(-1, 1), pick.randrange(-1080, 1000)) for _ in range(n)]


def nearest(xs):
    return float(sum(map(Fraction, xs)))


@pytest.mark.parametrize("seed", range(20))
def test_pieces_add_up(seed):
    xs = values(seed, 300) + [0.0, -0.0, 5e-324, -5e-324, 2.0 ** -1022, 1e308, -1e308, 1e-310]
    index, position, part = exactsum.pieces(np.array(xs))
    whole = [Fraction(0)] * len(xs)
    for i, p, s in zip(index.tolist(), position.tolist(), part.tolist()):
        assert 0 <= p < exactsum.BINS and abs(s) < 1 << 33
        whole[i] += Fraction(s) * Fraction(2) ** (exactsum.WIDTH * p + exactsum.LOWEST)
    assert whole == [Fraction(x) for x in xs]
    totals = {}
    for i in range(0, len(xs), 37):
        exactsum.add(totals, "k", np.array(xs[i:i + 37]))
    assert exactsum.total((p, s) for (_, p), s in totals.items()) == nearest(xs)


def test_no_numbers_and_overflow():
    def total(xs):
        totals = {}
        exactsum.add(totals, 0, np.array(xs))
        return exactsum.total((p, s) for (_, p), s in totals.items())

    assert math.isnan(total([1.0, math.nan])) and math.isnan(total([math.inf, -math.inf]))
    assert total([math.inf, 1.0]) == math.inf and total([-math.inf, 1e308]) == -math.inf
    assert total([1e308] * 3) == math.inf and total([1e308, 1e308, -1e308]) == 1e308
    assert total([]) == 0.0 and total([1e100, 1.0, -1e100]) == 1.0


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_any_partitioning(spark, parts):
    xs = values(5, 2000)
    rows = [(i % 3, x, None if i % 5 else 0.1) for i, x in enumerate(xs)] + [(None, 1.0, None)]
    df = spark.createDataFrame(rows, "k int, x double, y double").repartition(parts, F.rand(parts))
    got = {r.k: (r.x, r.y) for r in exactsum.exact_sums(df, ["x", "y"], ["k"]).collect()}
    for k in (0, 1, 2):
        assert got[k] == (nearest([x for i, x in enumerate(xs) if i % 3 == k]), nearest([0.1] * sum(i % 3 == k and i % 5 == 0 for i in range(2000))))
    assert got[None] == (1.0, None)
    assert exactsum.exact_sums(df.where("k >= 0"), ["x"]).first().x == nearest(xs)


def test_keys_of_several_columns_and_none(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 1, 0.25), ("a", None, 1.0)], "s string, k int, x float")
    assert sorted(map(repr, map(tuple, exactsum.exact_sums(df, ["x"], ["s", "k"]).collect()))) == ["('a', 1, 0.75)", "('a', None, 1.0)"]
    assert exactsum.exact_sums(df.where("x > 9"), ["x"], ["s"]).collect() == []
    assert [tuple(r) for r in exactsum.exact_sums(df.where("x > 9"), ["x"]).collect()] == [(None,)]
