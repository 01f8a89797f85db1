import math

import numpy as np

from quarry.llm import vptree


def vectors(n, dims, seed=5):
    """Clustered points with ties and copies."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dims)) + 4 * rng.integers(0, 3, size=(n, 1))
    points[::7] = np.round(points[::7])
    points[1::10] = points[0]
    return points


def distance(a, b):
    total = 0.0  # sum() would compensate
    for x, y in zip(a, b):
        total += (x - y) * (x - y)
    return math.sqrt(total)


def brute(rows, queries, k):
    out = []
    for q, a in queries:
        d = sorted((distance(a, b), i) for i, b in rows if i != q and len(a) == len(b))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(d[:k])]
    return sorted(out)


def test_exact_against_brute_force(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(1500, 6))] + [(5000 + i, v.tolist()) for i, v in enumerate(vectors(12, 3))]
    bad = [(6000, None), (6001, []), (6002, [0.0] * 6), (6003, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (6004, [float("nan")] * 6),
           (6005, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], "vec_id bigint, embedding array<double>, rank int, score string")
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert sorted(map(tuple, vptree.neighbours(df).collect())) == want
    usable = vptree.usable(df)
    small = vptree.nearest(usable, usable.where("vec_id % 100 = 0"), shard_rows=100, block_rows=4)
    assert sorted(map(tuple, small.collect())) == want


def test_relaxed_recall():
    points = vectors(4000, 16)
    ids, q = np.arange(4000), np.arange(0, 4000, 50)
    tree = vptree.Tree(points)
    exact = vptree.search(tree, ids, points[q], q, 10, 1.0)[0]
    relaxed = vptree.search(tree, ids, points[q], q, 10, 1.2)[0]
    assert (np.abs(relaxed - exact) < 1e-12).mean() >= 0.9


def test_repeated_rows_and_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert sorted(map(tuple, vptree.neighbours(df).collect())) == [(0, 1, 2, 0.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0)]
    assert vptree.neighbours(df.where("1 = 0")).collect() == []


def test_a_row_repeated_often(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(300, 4))] + [(7, vectors(300, 4)[7].tolist())] * 200
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    index = vptree.index(vptree.usable(df), k=10, shard_rows=64)
    assert index.selectExpr("sum(length(ids) / 8) AS n").first().n == 310 - 1  # 10 of the 201 equal rows
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert sorted(map(tuple, vptree.neighbours(df).collect())) == want


def test_a_tree_survives_its_writing():
    points = vectors(2000, 8)
    tree, q = vptree.Tree(points), np.arange(0, 2000, 50)
    again = vptree.Tree(points, tree.order, np.array(tree.nodes, dtype=np.float64))
    assert again.nodes == tree.nodes
    for a, b in zip(vptree.search(tree, np.arange(2000), points[q], q, 10, 1.0), vptree.search(again, np.arange(2000), points[q], q, 10, 1.0)):
        assert (a == b).all()


def test_squares_beyond_a_double(spark):
    big = [(0, [1e200, 0.0]), (1, [0.0, 1e200]), (2, [2e200, 1e190]), (100, [1.0, 1.0])]
    df = spark.createDataFrame(big, "vec_id bigint, embedding array<double>")
    rows = vptree.neighbours(df).collect()
    near = {q: [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 100)}
    assert near == {0: [2, 100, 1], 100: [0, 1, 2]}
    for r in rows:
        assert math.isclose(r.score, math.dist(dict(big)[r.query_id], dict(big)[r.vec_id]), rel_tol=1e-12)


def test_a_large_shard_of_large_vectors(spark):
    rows = [(i, (v * 2.0 ** 600).tolist()) for i, v in enumerate(vectors(900, 4))]
    small = [(i, [x * 2.0 ** -600 for x in v]) for i, v in rows]
    both = []
    for some, scale in ((rows, 2.0 ** -600), (small, 1.0)):
        found = vptree.neighbours(spark.createDataFrame(some, "vec_id bigint, embedding array<double>")).collect()
        both.append(sorted((r.query_id, r["rank"], r.vec_id, r.score * scale) for r in found))
    assert both[0] == both[1]
