import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import kmeans
from quarry.plans import queries as Q

from paths import SF_SMALL


def numpy_lloyd(ids, X, k, rounds):
    order = sorted(range(len(ids)), key=lambda i: hashlib.md5(str(ids[i]).encode()).hexdigest())
    C = X[order[:k]].copy()
    for _ in range(rounds):
        d = ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
        a = d.argmin(axis=1)
        for j in range(k):
            if (a == j).any():
                C[j] = X[a == j].mean(axis=0)
    d = ((X[:, None, :] - C[None, :, :]) ** 2).sum(axis=2)
    return C, d.argmin(axis=1), d.min(axis=1).sum()


@pytest.fixture(scope="module")
def q20(spark):
    spec = Q.CLUSTER_SPECS["q20"]
    pdf = spec.features(spark, SF_SMALL).toPandas()
    return spec, pdf


def test_lloyd_matches_numpy(spark, q20):
    spec, pdf = q20
    cols = list(spec.cols)
    pts = spark.createDataFrame(pdf)
    model = kmeans.fit(pts, spec.id_col, cols, k=8, max_iter=10)
    C, a, cost = numpy_lloyd(pdf[spec.id_col].tolist(), pdf[cols].to_numpy(float), 8, 10)
    assert np.allclose(np.array(model.centers), C, rtol=1e-9, atol=1e-9)
    assigned = kmeans.assign(pts, model)
    got_cost = kmeans.cost(assigned, digits=None).first().cost
    assert got_cost == pytest.approx(cost, rel=1e-9)
    sizes = {r.cluster_id: r.n for r in kmeans.cluster_sizes(assigned, 8).collect()}
    assert sizes == {j: int((a == j).sum()) for j in range(8)}


def test_invariants_and_partition_independence(spark, q20):
    spec, pdf = q20
    cols = list(spec.cols)
    pts = spark.createDataFrame(pdf)
    results = []
    for parts in (1, 7):
        model = kmeans.fit(pts.repartition(parts), spec.id_col, cols, k=8, max_iter=10)
        results.append(np.array(model.centers))
        sizes = kmeans.cluster_sizes(kmeans.assign(pts, model), 8)
        assert sizes.agg(F.sum("n")).first()[0] == len(pdf)
    assert np.allclose(results[0], results[1], rtol=1e-12, atol=1e-12)
    # the cost never rises from one round to the next
    costs = []
    for rounds in range(1, 6):
        m = kmeans.fit(pts, spec.id_col, cols, k=8, max_iter=rounds)
        costs.append(kmeans.cost(kmeans.assign(pts, m), digits=None).first().cost)
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:]))


def test_wide_k_uses_array_form(spark):
    rows = [(i, float(i % 50), float(i // 50)) for i in range(500)]
    pts = spark.createDataFrame(rows, "id long, x double, y double")
    centers = [[float(j), float(j % 10)] for j in range(3000)]
    m = kmeans.KMeansModel(["x", "y"], centers)
    got = kmeans.assign(pts, m).select("id", "cluster_id").orderBy("id").collect()
    C = np.array(centers)
    X = np.array([[r[1], r[2]] for r in rows])
    expect = ((X[:, None, :] - C[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert [r.cluster_id for r in got] == expect.tolist()


def test_native_cost_matches_relational_cost(spark, q20):
    spec, pdf = q20
    cols = list(spec.cols)
    pts = spark.createDataFrame(pdf)
    model, _ = kmeans.fit_native(pts, cols, k=8, max_iter=10, seed=7)
    ours = kmeans.KMeansModel(cols, [list(map(float, c)) for c in model.clusterCenters()])
    cost = kmeans.cost(kmeans.assign(pts, ours), digits=None).first().cost
    assert cost == pytest.approx(model.summary.trainingCost, rel=1e-9)


@pytest.mark.parametrize("k,dims", [(4, 2), (9, 2), (8, 8)])
def test_points_with_gaps_have_no_cluster(spark, k, dims):
    """One path at every size: a NaN, null or infinite coordinate changes nobody else's cluster."""
    cols = [f"x{i}" for i in range(dims)]
    types = "id int, " + ", ".join(f"{c} double" for c in cols)
    rows = [(i, *[float((i * (j + 3)) % 17) for j in range(dims)]) for i in range(40)]
    gaps = [(100 + i, *[x] * (dims - 1), 1.0) for i, x in enumerate([float("nan"), None, float("inf")])]
    clean, full = (spark.createDataFrame(r, types) for r in (rows, rows + gaps))
    a, b = kmeans.fit(clean, "id", cols, k=k), kmeans.fit(full, "id", cols, k=k)
    assert a.centers == b.centers
    assigned = kmeans.assign(full, b)
    placed = kmeans.assign(clean, a).select("id", "cluster_id", "dist2").collect()
    assert sorted(placed) == sorted(assigned.where("id < 100").select("id", "cluster_id", "dist2").collect())
    assert len({r.cluster_id for r in placed}) > 1
    assert kmeans.unplaced(assigned).first().n_unplaced == 3
    assert kmeans.cluster_sizes(assigned, k).agg(F.sum("n")).first()[0] == 40


def test_small_distances_are_not_rounded_away(spark):
    df = spark.createDataFrame([(0.01, 0), (0.03, 0)], "x double, cluster_id int")
    model = kmeans.KMeansModel(["x"], [[0.015]])
    assert kmeans.cost(kmeans.assign(df.select("x"), model)).first().cost == pytest.approx(0.00025, rel=1e-9)


def test_best_of_runs_keeps_the_lowest_cost(spark, q20):
    spec, pdf = q20
    cols = list(spec.cols)
    pts = spark.createDataFrame(pdf)

    def cost_of(model):
        return kmeans.cost(kmeans.assign(pts, model), digits=None).first().cost

    singles = [cost_of(kmeans.fit(pts, spec.id_col, cols, k=8, max_iter=5, init="random", seed=s))
               for s in (11, 12, 13)]
    best = kmeans.fit_best_of(pts, spec.id_col, cols, k=8, max_iter=5, runs=3, seed=11)
    assert cost_of(best) == pytest.approx(min(singles), rel=1e-12)
