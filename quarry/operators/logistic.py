"""Binary logistic regression by full-batch gradient descent with an L1 penalty
(M1, M2, K1, S7, P5, P6).

Per pass i = 1..passes, with x extended by a constant 1 (the intercept) and
the starting weights (0, ..., 0, 1):

    g   = mean over rows of (sigmoid(w . x) - y) * x
    s   = rate / sqrt(i)
    w  <- soft(w - s g, lambda s),   soft(v, t) = sign(v) * max(0, |v| - t)

(the penalty also shrinks the intercept). These are the update rules of
gradient descent with the L1 updater and mini-batch fraction 1.0.

Only d + 1 numbers travel to the driver and back a pass, so the plan never grows. Two plans:

* **grouped**, for flags and other features of few values: rows with the same (features, label) are
  first grouped into weighted rows (partial aggregation), a handful, and each pass aggregates these;
* **by row**, for continuous features, where grouping would shuffle every row and join none: the rows
  are written once, and each pass scans them. One NumPy kernel adds an Arrow batch's gradient by two matrix products, a
  task sends d + 2 sums, and Spark adds those by position: no row is exchanged. The
  weights go out as one array in the kernel, so the passes share one plan without code made anew.

``fit`` takes the columns of a table, ``fit_vectors`` one column of vectors. Rows with a null, NaN or
infinite feature or label take no part and are counted (``n_incomplete``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import fixed
from ..session import materialize
from . import manifest

# Defaults of the training job when no value is given: passes, lambda, rate.
DEFAULT_PASSES = 2
DEFAULT_LAMBDA = 1e-4
DEFAULT_RATE = 1e-3


@dataclass
class LogisticModel:
    feature_cols: list[str]
    weights: list[float]
    intercept: float
    threshold: float = 0.5
    n_rejected: int = 0             # input lines that the training job could not parse
    history: list[list[float]] = field(default_factory=list)
    vector_col: str | None = None   # the column of vectors whose entries are the features
    n_incomplete: int = 0           # rows that took no part in the fit

    def margin(self) -> Column:
        if self.vector_col:
            products = F.zip_with(F.col(self.vector_col), F.lit([float(w) for w in self.weights]), lambda x, w: w * x)
            return F.aggregate(products, F.lit(0.0), lambda a, b: a + b) + F.lit(float(self.intercept))
        z = F.lit(0.0)
        for i, (f, w) in enumerate(zip(self.feature_cols, self.weights)):
            term = F.lit(float(w)) * F.col(f)
            z = term if i == 0 else z + term
        return z + F.lit(float(self.intercept))

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))

    def predict(self) -> Column:
        return F.when(self.probability() > F.lit(self.threshold), F.lit(1.0)).otherwise(F.lit(0.0))


def _soft(v: float, t: float) -> float:
    return math.copysign(1.0, v) * max(0.0, abs(v) - t) if v != 0.0 else 0.0


GROUPING_PAYS = 8   # rows a distinct (features, label) must have on average


def fit(data: DataFrame, feature_cols: list[str], label_col: str = "label",
        passes: int = DEFAULT_PASSES, rate: float = DEFAULT_RATE,
        lam: float = DEFAULT_LAMBDA, grouped: bool | None = None) -> LogisticModel:
    """Fit on columns. ``grouped`` picks the plan; None measures how many distinct rows there are."""
    feature_cols = list(feature_cols)
    rows = data.select(*[F.col(f).cast("double").alias(f"_x{j}") for j, f in enumerate(feature_cols)],
                       F.col(label_col).cast("double").alias("_y"))
    xs = [f"_x{j}" for j in range(len(feature_cols))]
    known = _finite(F.col("_y"))
    for x in xs:
        known = known & _finite(F.col(x))
    model = LogisticModel(feature_cols, [0.0] * len(xs), 1.0)
    if not grouped:
        rows, n_rows = _kept(model, rows, known)
        if grouped is None:
            distinct = rows.agg(F.approx_count_distinct(F.xxhash64(*rows.columns))).first()[0]
            grouped = distinct * GROUPING_PAYS <= n_rows
    if grouped:
        all_rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
        whole = materialize(all_rows.withColumn("_known", known))
        rows = whole.where("_known")
        if not model.n_incomplete:
            model.n_incomplete = whole.where("NOT _known").agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
        gradient = lambda m: _grouped_sums(rows, xs, m)
    else:
        gradient = lambda m: _row_sums(rows, xs, m)
    return _descend(model, gradient, passes, rate, lam)


def fit_vectors(data: DataFrame, vector_col: str = "features", label_col: str = "label",
                passes: int = DEFAULT_PASSES, rate: float = DEFAULT_RATE, lam: float = DEFAULT_LAMBDA,
                width: int | None = None) -> LogisticModel:
    """Fit on a column of vectors, by row. Without ``width`` all vectors must have that of the first rows'; one
    of another width fails the job. The terms are called ``x0``, ``x1``, ..."""
    if width is None:
        first = data.where(F.col(vector_col).isNotNull()).select(F.size(vector_col).alias("n")).first()
        if first is None:
            raise ValueError("no training rows")
        width = first["n"]
    vector = F.col(vector_col).cast("array<double>")
    wrong = F.raise_error(F.concat(F.lit(f"a training vector has not {width} entries but "), F.size(vector).cast("string")))
    rows = data.select(F.when(vector.isNull() | (F.size(vector) == width), vector).otherwise(wrong).alias("_x"),
                       F.col(label_col).cast("double").alias("_y"))
    known = F.col("_x").isNotNull() & _finite(F.col("_y")) & F.forall("_x", lambda x: F.coalesce(_finite(x), F.lit(False)))
    model = LogisticModel([f"x{j}" for j in range(width)], [0.0] * width, 1.0, vector_col=vector_col)
    rows, _ = _kept(model, rows, known)
    return _descend(model, lambda m: _row_sums(rows, None, m), passes, rate, lam)


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _kept(model: LogisticModel, rows: DataFrame, known: Column) -> tuple[DataFrame, int]:
    """The rows that take part, written once, and their number; the others are counted by the same job."""
    seen = Observation()
    observed = rows.withColumn("_known", F.coalesce(known, F.lit(False))) \
        .observe(seen, F.count_if("_known").alias("known"), F.count_if(~F.col("_known")).alias("incomplete"))
    kept = materialize(observed.where("_known").drop("_known"))
    model.n_incomplete = seen.get["incomplete"]
    return kept, seen.get["known"]


def _descend(model: LogisticModel, gradient, passes: int, rate: float, lam: float) -> LogisticModel:
    """The passes: ``gradient(model)`` gives d + 1 sums and the number of rows."""
    for i in range(1, passes + 1):
        *sums, n_rows = gradient(model)
        if not n_rows:
            raise ValueError("no training rows")
        step = rate / math.sqrt(i)
        shrink = lam * step
        *model.weights, model.intercept = (_soft(w - step * (g / n_rows), shrink)
                                           for w, g in zip([*model.weights, model.intercept], sums))
        model.history.append(model.weights + [model.intercept])
    return model


def _grouped_sums(rows: DataFrame, xs: list[str], model: LogisticModel) -> list[float]:
    own = LogisticModel(xs, model.weights, model.intercept)
    err = (own.probability() - F.col("_y")) * F.col("_n")
    row = rows.agg(*[F.sum(err * F.col(x)).alias(x) for x in xs], F.sum(err).alias("_b"), F.sum("_n").alias("_rows")).first()
    return [*row]


def _row_sums(rows: DataFrame, xs: list[str] | None, model: LogisticModel) -> list[float]:
    """Columns ``xs``, or the vectors ``_x``: a task adds its batches, Spark adds the tasks' d + 2 sums by position."""
    weights, intercept = list(model.weights), float(model.intercept)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        w = np.array(weights, dtype=np.float64)
        sums = np.zeros(len(w) + 2)
        for batch in batches:
            y = batch.column(batch.num_columns - 1).to_numpy()
            if xs is None:
                x = batch.column(0).flatten().to_numpy().reshape(len(y), len(w))
            else:
                x = np.column_stack([np.zeros((len(y), 0)), *[batch.column(j).to_numpy() for j in range(len(xs))]])
            with np.errstate(over="ignore"):        # exp beyond a double: a probability of 0
                err = 1.0 / (1.0 + np.exp(-(x @ w + intercept))) - y
            sums += np.concatenate([err @ x, [err.sum(), len(y)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["at", "s"])

    found = rows.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()     # d + 2 rows
    by_place = {r["at"]: r["s"] for r in found}
    return [by_place.get(j, 0.0) for j in range(len(weights) + 2)]


def score(model: LogisticModel, data: DataFrame, keep: tuple[str, ...] = (),
          label_col: str = "label") -> DataFrame:
    """Rows with ``probability`` and ``prediction`` (0/1) added (M2)."""
    return data.select(*keep, F.col(label_col).cast("double").alias("label"),
                       model.probability().alias("probability"),
                       model.predict().alias("prediction"))


def weights_frame(spark, model: LogisticModel, digits: int = 6) -> DataFrame:
    """(term, weight) rows; the intercept is the term ``intercept``."""
    rows = list(zip(model.feature_cols, model.weights)) + [("intercept", model.intercept)]
    return spark.createDataFrame(rows, "term string, weight double") \
        .select("term", fixed(F.col("weight"), digits).alias("weight"))


def save(model: LogisticModel, path: str, mode: str = "overwrite") -> None:
    """Write the model as one small Parquet table and a manifest (K1)."""
    spark = _active()
    rows = [(i, f, float(w)) for i, (f, w) in enumerate(zip(model.feature_cols, model.weights))]
    rows.append((-1, "intercept", float(model.intercept)))
    spark.createDataFrame(rows, "pos int, term string, weight double").coalesce(1) \
        .write.mode(mode).parquet(f"{path}/weights")
    content = {"features": list(model.feature_cols), "threshold": model.threshold, "vector_col": model.vector_col,
               "n_rejected": model.n_rejected, "n_incomplete": model.n_incomplete}
    manifest.write(spark, path, "logistic", content, ["weights"])


def load(spark, path: str, feature_cols: list[str] | None = None) -> LogisticModel:
    """Read a model written by ``save`` (S7), checked against its manifest. ``feature_cols`` are the features
    that the caller has: the model's own, in any order; a missing or a further one fails with its name."""
    found = manifest.read(spark, path, "logistic")
    rows = spark.read.parquet(f"{path}/weights").orderBy("pos").collect()   # d + 1 rows
    terms = {r["term"]: r["weight"] for r in rows if r["pos"] >= 0}   # features may have any name
    intercept = {r["pos"]: r["weight"] for r in rows}[-1]
    if list(terms) != found["features"]:
        raise manifest.ModelError(f"the terms of the model in {path} are {list(terms)}, saved were {found['features']}")
    cols = list(feature_cols or terms)
    for c in sorted({*cols} ^ {*terms}):
        raise manifest.ModelError(f"feature {c!r} is " + (f"not in the model in {path}" if c in cols else f"missing: the model in {path} needs it"))
    return LogisticModel(cols, [terms[c] for c in cols], intercept, found["threshold"], found["n_rejected"],
                         vector_col=found["vector_col"], n_incomplete=found["n_incomplete"])


def _active():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def fit_native(data: DataFrame, feature_cols: list[str], label_col: str = "label",
               passes: int = 20, lam: float = 0.1):
    """Spark ML logistic regression with a pure L1 penalty (a different optimiser,
    so different weights); returns (model, assembled data)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    vec = VectorAssembler(inputCols=list(feature_cols), outputCol="features").transform(
        data.withColumn(label_col, F.col(label_col).cast("double")))
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=passes,
                            regParam=lam, elasticNetParam=1.0, standardization=False)
    return lr.fit(vec), vec
