"""k-means clustering.

Lloyd's algorithm as DataFrame aggregations. Each round is one scan of the
(materialized) points:

* assignment is one NumPy kernel on Arrow batches, the same for every k and
  width; ties go to the lowest cluster id. No join, no broadcast, and the plan
  does not grow from round to round. Points with a null, NaN or infinite
  coordinate are left out of the means and the cost, and counted;
* the update is in the same kernel: a task adds the points of each cluster and sends
  one set of sums a cluster, no matter how many points it holds or how unbalanced the clusters are;
* several runs share the scan: each round assigns every point under the centres of all runs
  that have not ended yet, and each run ends by itself;
* only model-sized sums (k x d for a run) come back to the driver.

A cluster that receives no points keeps its previous centre, as in MLlib.

Sums are exact (``functions.exactsum``), so every round - and hence the result - is
bit-identical however the points are partitioned and whichever order the partial sums
merge in. With ``exact_scale`` (the number of decimals the features carry) a mean is that of the
decimal numbers, not of the doubles next to them.

Start: ``init="md5"`` takes the k points with the lowest ``md5(id)`` (a
deterministic, checkable choice; the original draws k random points, which
``init="random"`` does with a seed). The native ``pyspark.ml`` k-means is
wrapped by ``fit_native`` for users who want MLlib's k-means|| start.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exactsum
from ..session import materialize
from .sizing import broadcast_if_bounded

CLUSTER = "cluster_id"
DIST2 = "dist2"
@dataclass
class KMeansModel:
    feature_cols: list[str]
    centers: list[list[float]]
    rounds: int = 0
    history: list[float] = field(default_factory=list)   # largest squared shift per round
    run_costs: list[float] = field(default_factory=list)  # of all runs, if this is the best of several

    @property
    def k(self) -> int:
        return len(self.centers)


def complete(feature_cols: list[str]) -> Column:
    """Whether a point can be placed: no coordinate is null, NaN or infinite."""
    usable = [F.col(f).isNotNull() & ~F.isnan(F.col(f)) & (F.abs(F.col(f)) < float("inf")) for f in feature_cols]
    return reduce(lambda a, b: a & b, usable)


def nearest(x, centers):
    """(nearest centre, squared distance) of each row of ``x``. Squared differences are added
    dimension by dimension, left to right; ties go to the lowest id."""
    import numpy as np

    acc = np.zeros((len(x), len(centers)), dtype=np.float64)
    for j in range(centers.shape[1]):
        diff = x[:, j][:, None] - centers[None, :, j]
        acc += diff * diff
    best = acc.argmin(axis=1) if len(x) else np.zeros(0, dtype=np.int64)
    return best, acc[np.arange(len(x)), best]


def assign(points: DataFrame, model: KMeansModel) -> DataFrame:
    """Points with ``cluster_id`` (nearest centre) and ``dist2`` appended.

    One NumPy kernel on Arrow batches (``nearest``). A point with a null, NaN or infinite
    coordinate has no nearest centre: both columns are null (``unplaced`` counts them).
    """
    points = points.select(*points.columns)
    cols = list(model.feature_cols)
    centers = [list(map(float, c)) for c in model.centers]
    schema = T.StructType(points.schema.fields + [T.StructField(CLUSTER, T.IntegerType()), T.StructField(DIST2, T.DoubleType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        C = np.asarray(centers, dtype=np.float64)
        for batch in batches:
            x = np.empty((batch.num_rows, len(cols)))
            for j, name in enumerate(cols):
                x[:, j] = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
            gap = ~np.isfinite(x).all(axis=1)
            best, dist = nearest(np.where(np.isfinite(x), x, 0.0), C)
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [pa.array(best.astype(np.int32), mask=gap), pa.array(dist, mask=gap)],
                names=list(batch.schema.names) + [CLUSTER, DIST2])

    return points.mapInArrow(run, schema)


def unplaced(assigned: DataFrame) -> DataFrame:
    """Number of points without a cluster, one row."""
    return assigned.agg(F.count_if(F.col(CLUSTER).isNull()).alias("n_unplaced"))


def _start_order(id_col: str, init: str, seed: int) -> Column:
    if init == "md5":
        return F.md5(F.col(id_col).cast("string"))
    if init == "salted":
        return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    if init == "random":
        return F.xxhash64(F.col(id_col), F.lit(seed))
    raise ValueError(f"unknown init {init!r}")


def initial_centers(points: DataFrame, id_col: str, feature_cols: list[str], k: int,
                    init: str = "md5", seed: int = 42) -> list[list[float]]:
    """k starting centres, drawn by a distributed top-k (no full sort)."""
    return starts(points, id_col, feature_cols, k, init, [seed])[0]


def starts(points: DataFrame, id_col: str, feature_cols: list[str], k: int, init: str, seeds: list[int]) -> list[list[list[float]]]:
    """k starting centres for each seed. Several seeds take one scan: each task sends its k first points a seed."""
    usable = points.where(complete(feature_cols))
    if len(seeds) == 1:
        rows = usable.select(F.lit(0).alias("_run"), _start_order(id_col, init, seeds[0]).alias("_o"), *feature_cols).orderBy("_o").limit(k)
    else:
        order = F.posexplode(F.array(*[_start_order(id_col, init, s) for s in seeds]))
        rank = F.row_number().over(Window.partitionBy("_run").orderBy("_o"))
        rows = usable.select(order.alias("_run", "_o"), *feature_cols).withColumn("_rank", rank).where(F.col("_rank") <= k)
    found: list[list] = [[] for _ in seeds]
    for r in sorted(rows.collect(), key=lambda r: r["_o"]):     # k rows a seed
        found[r["_run"]].append([float(r[f]) for f in feature_cols])
    if len(found[0]) < k:
        raise ValueError(f"need at least k={k} points, got {len(found[0])}")
    return found


def _scan(points: DataFrame, feature_cols: list[str], centers: dict[int, list[list[float]]], exact_scale: int | None, costs: bool = False):
    """One scan for all runs: {(run, cluster): (n, [sum of each feature, in units of the scale])}, or with ``costs`` {run: sum of squared distances}; sums exact."""
    d = len(feature_cols)
    factor = None if exact_scale is None else float(10 ** exact_scale)

    def run(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        spots = exactsum.DOWN + 1
        totals: dict = {}
        for batch in batches:
            x = np.column_stack([batch.column(j).to_numpy(zero_copy_only=False).astype(np.float64) for j in range(d)])
            x = x[np.isfinite(x).all(axis=1)]
            if not len(x):
                continue
            cut = [] if costs else [exactsum.pieces(x[:, j] if factor is None else np.rint(x[:, j] * factor)) for j in range(d)]
            for number, those in centers.items():
                best, dist = nearest(x, np.asarray(those, dtype=np.float64))
                k = len(those)
                if costs:
                    exactsum.add(totals, (number, 0, 0), dist)
                    continue
                for c, n in enumerate(np.bincount(best, minlength=k).tolist()):
                    totals[(number, c, -1), 0] = totals.get(((number, c, -1), 0), 0) + n
                for j, (index, position, part) in enumerate(cut):
                    sums = np.zeros(k * spots, dtype=np.int64)
                    np.add.at(sums, best[index] * spots + position, part)
                    for at in np.flatnonzero(sums).tolist():
                        key = (number, at // spots, j), at % spots
                        totals[key] = totals.get(key, 0) + int(sums[at])
        rows = [dict(zip(sent.names, (*key, position, Decimal(s)))) for (key, position), s in totals.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=exactsum.arrow_schema(sent))

    sent = T.StructType([T.StructField(c, T.IntegerType()) for c in ("run", "cluster", "column", "position")] + [T.StructField("part", T.DecimalType(38, 0))])
    found: dict = {}
    for r in points.select(*feature_cols).mapInArrow(run, sent).groupBy("run", "cluster", "column", "position").agg(F.sum("part").alias("part")).collect():
        found.setdefault((r["run"], r["cluster"], r["column"]), []).append((r["position"], int(r["part"])))
    if costs:
        return {number: exactsum.total(found.get((number, 0, 0), [])) for number in centers}
    out = {}
    for (number, c, column), parts in found.items():
        if column == -1 and parts[0][1]:
            sums = [exactsum.total(found.get((number, c, j), [])) for j in range(d)]
            out[number, c] = (parts[0][1], sums)
    return out


def fit_runs(points: DataFrame, feature_cols: list[str], first: list[list[list[float]]], max_iter: int = 10,
             tol: float = 0.0, exact_scale: int | None = None) -> list[KMeansModel]:
    """Lloyd rounds from each of the starts ``first``, all in one scan a round; a run
    ends after ``max_iter`` rounds, or when no centre of it moved more than ``tol``. ``points`` must be materialized."""
    models = [KMeansModel(list(feature_cols), [list(c) for c in centers]) for centers in first]
    unit = 1.0 if exact_scale is None else float(10 ** exact_scale)
    active = dict(enumerate(models))
    for _ in range(max_iter):
        if not active:
            break
        stats = _scan(points, list(feature_cols), {r: m.centers for r, m in active.items()}, exact_scale)
        for number, model in list(active.items()):
            new = [[s / stats[number, c][0] / unit for s in stats[number, c][1]] if (number, c) in stats else list(old)
                   for c, old in enumerate(model.centers)]
            shift = max(sum((a - b) ** 2 for a, b in zip(old, moved)) for old, moved in zip(model.centers, new))
            model.centers = new
            model.rounds += 1
            model.history.append(shift)
            if shift <= tol * tol:
                del active[number]
    return models


def fit(points: DataFrame, id_col: str, feature_cols: list[str], k: int = 8,
        max_iter: int = 10, tol: float = 0.0, init: str = "md5", seed: int = 42,
        materialized: bool = False, exact_scale: int | None = None) -> KMeansModel:
    """Lloyd rounds; stops early only when no centre moved more than ``tol``."""
    feature_cols = list(feature_cols)
    pts = points.select(id_col, *[F.col(f).cast("double").alias(f) for f in feature_cols])
    if not materialized:
        pts = materialize(pts)
    return fit_runs(pts, feature_cols, [initial_centers(pts, id_col, feature_cols, k, init, seed)], max_iter, tol, exact_scale)[0]


def fit_best_of(points: DataFrame, id_col: str, feature_cols: list[str], k: int = 8,
                max_iter: int = 10, runs: int = 1, seed: int = 42, exact_scale: int | None = None,
                init: str = "random", materialized: bool = False) -> KMeansModel:
    """``runs`` fits (seeds seed .. seed+runs-1) in the scans of the longest one; keeps the one with the
    lowest cost, the first of equal ones (D11: the original ``runs`` argument). ``run_costs`` has the cost of each."""
    pts = points if materialized else materialize(points.select(id_col, *[F.col(f).cast("double").alias(f) for f in feature_cols]))
    seeds = [seed + r for r in range(max(1, runs))]
    models = fit_runs(pts, feature_cols, starts(pts, id_col, feature_cols, k, init, seeds), max_iter, exact_scale=exact_scale)
    costs = _scan(pts, feature_cols, {r: m.centers for r, m in enumerate(models)}, None, costs=True)
    best = models[min(costs, key=lambda r: (costs[r], r))]
    best.run_costs = [costs[r] for r in range(len(models))]
    return best


def cluster_sizes(assigned: DataFrame, k: int) -> DataFrame:
    """Points per cluster for all k ids; empty clusters show 0."""
    counts = assigned.groupBy(CLUSTER).agg(F.count("*").alias("n"))
    ids = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias(CLUSTER))
    # counts has at most k rows and one for the points without a cluster
    return (ids.join(broadcast_if_bounded(counts, k + 1, 32), CLUSTER, "left")
            .select(CLUSTER, F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def cost(assigned: DataFrame, digits: int | None = 10) -> DataFrame:
    """Sum of squared distances to the nearest centre (A9), one row.

    The sum is exact, then rounded to the nearest double; with ``digits``, to so many significant
    digits, which an engine that adds doubles one by one gives as well.
    """
    total = exactsum.exact_sums(assigned, [DIST2]).withColumnRenamed(DIST2, "cost")
    if digits is None:
        return total
    return total.select(significant(F.col("cost"), digits).alias("cost"))


def significant(x: Column, digits: int) -> Column:
    """A value of at least 0, rounded to so many significant digits."""
    factor = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(x)))
    return F.when(x == 0, F.lit(0.0)).otherwise(F.round(x * factor) / factor)


def centers_frame(spark, model: KMeansModel) -> DataFrame:
    """The k x d centre matrix as rows (cluster_id, <feature cols>)."""
    rows = [(i, *c) for i, c in enumerate(model.centers)]
    schema = ", ".join([f"{CLUSTER} int"] + [f"`{f}` double" for f in model.feature_cols])
    return spark.createDataFrame(rows, schema)


def report(assigned: DataFrame, model: KMeansModel) -> DataFrame:
    """Centres with their sizes (M5 + A8): cluster_id, <feature cols>, n."""
    centers = centers_frame(assigned.sparkSession, model)
    return broadcast_if_bounded(centers, model.k, 8 * (len(model.feature_cols) + 2)).join(cluster_sizes(assigned, model.k), CLUSTER)


def fit_native(points: DataFrame, feature_cols: list[str], k: int = 8, max_iter: int = 10,
               seed: int = 42, init_mode: str = "random", tol: float = 1e-4):
    """MLlib k-means on an assembled vector column; returns (model, predictions)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(points)
    km = KMeans(k=k, maxIter=max_iter, seed=seed, initMode=init_mode, tol=tol,
                featuresCol="features", predictionCol=CLUSTER)
    model = km.fit(vec)
    return model, model.transform(vec)
