"""File-based jobs with the parameters of the original command-line jobs (§2.9).

For users whose feature extraction already writes the three text shapes:

* ``train_logistic(input, output, passes=2, lam=1e-4, rate=1e-3)`` and
  ``run_logistic(input, model)`` - comma records;
* ``run_kmeans(input, output, k, max_iteration, runs=1)`` - space records;
* ``run_naive_bayes(train_input, model_output, test_input, result_output)``
  - tab records.

Inputs may be files or directories of part files; each is scanned once, and the rejected lines are
counted by the job that reads the good ones. Each job fails if there is nothing to work on, returns its
result DataFrames and writes what the original wrote (model, report text);
the text sinks replace their target only once the new text is whole. The results are lazy and read tables in the
shared folder: use a ``kept_tables`` scope to have these removed after use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bayes, evaluate, kmeans, logistic, report
from ..session import kept_tables, materialize
from ..sources import readers
from ..sources.extract import Q28_LABELS

COMMA_FEATURES = ["college_education", "male"]


def _counted(spark: SparkSession, n: int) -> DataFrame:
    return spark.createDataFrame([(n,)], "n_rejected bigint")


def train_logistic(spark: SparkSession, input_path: str, output: str,
                   passes: int = logistic.DEFAULT_PASSES, lam: float = logistic.DEFAULT_LAMBDA,
                   rate: float = logistic.DEFAULT_RATE, feature_cols=None) -> logistic.LogisticModel:
    """Fit on comma records and save the model (M1, K1). ``feature_cols`` may add
    ``label`` to reproduce the original third feature (D1). The input is read once: the
    fit's first job also counts the rejected lines. Fails without a row to learn from."""
    with kept_tables(spark):    # nothing lazy leaves this job
        lines = readers.read_observed(spark, input_path, readers.observe_comma)
        model = logistic.fit(lines.good, list(feature_cols or COMMA_FEATURES), "label", passes, rate, lam)
    model.n_rejected = lines.n_rejected
    logistic.save(model, output)
    return model


def run_logistic(spark: SparkSession, input_path: str, model_path: str) -> dict[str, DataFrame]:
    """Load a model, score comma records, and evaluate (S7, M2, A6, A7). Fails without a row to score."""
    lines = readers.read_observed(spark, input_path, readers.observe_comma)
    model = logistic.load(spark, model_path)
    scored = report.require_rows(materialize(logistic.score(model, lines.good)), f"the scored input {input_path}")
    return {
        "accuracy": evaluate.accuracy(scored),
        "auc": evaluate.auc(scored, "probability"),
        "confusion": evaluate.confusion_long(scored),
        "rejected": _counted(spark, lines.n_rejected),
    }


def run_kmeans(spark: SparkSession, input_path: str, output: str | None, k: int,
               max_iteration: int, runs: int = 1, mode: str = "strict",
               seed: int = 42, width: int | None = None) -> dict[str, DataFrame]:
    """Cluster space records; write ``Cluster i [centre] n=size`` lines to ``output``
    and return centres with sizes and the cost (M3-M5, A8, A9, T16, K3, K5)."""
    if mode == "drop" and width is None:
        raise ValueError("mode 'drop' needs the width of the vectors: no row can say which rows are wrong")
    lines = readers.read_observed(spark, input_path, readers.observe_space, mode=mode, width=width)
    vectors = materialize(lines.good.withColumn("_id", F.monotonically_increasing_id()))
    report.require_rows(vectors, f"the vector input {input_path}")
    if width is None:  # strict: all rows must agree
        spread = vectors.agg(F.min(F.size("features")).alias("low"), F.max(F.size("features")).alias("high")).first()
        if spread["low"] != spread["high"]:
            raise ValueError("rows of different widths in the k-means input")
        width = spread["low"]
    cols = [f"x{i}" for i in range(width)]
    points = vectors.select("_id", *[F.col("features")[i].alias(c) for i, c in enumerate(cols)])
    model = kmeans.fit_best_of(points, "_id", cols, k=k, max_iter=max_iteration, runs=runs, seed=seed)
    assigned = kmeans.assign(points, model)
    result = report.require_rows(kmeans.report(assigned, model), "the cluster report")
    if output:
        report.write_text(report.cluster_lines(result, cols), output)
    return {"clusters": result, "cost": kmeans.cost(assigned, digits=None), "unplaced": kmeans.unplaced(assigned),
            "rejected": _counted(spark, lines.n_rejected)}


def run_naive_bayes(spark: SparkSession, train_input: str, model_output: str | None,
                    test_input: str, result_output: str | None, labels=Q28_LABELS,
                    idf_from: str = "test") -> dict[str, DataFrame]:
    """Train on tab records, save the model, score the test records and write the
    classification report (S5, T4-T11, M6, M7, A1-A5, R1, K2, K3)."""
    labels = list(labels)
    train = readers.read_observed(spark, train_input, readers.observe_tab, labels=labels)
    test = readers.read_observed(spark, test_input, readers.observe_tab, labels=labels)
    model = bayes.fit(train.good, id_col="review_id")
    if not model.n_train:
        raise RuntimeError(f"the training input {train_input} is empty")
    if model_output:
        bayes.save(model, model_output)
    scored = report.require_rows(materialize(bayes.score(model, test.good, id_col="review_id", idf_from=idf_from)),
                                 f"the test input {test_input}")
    summary = evaluate.summary(scored)
    matrix = evaluate.confusion_matrix(scored, labels)
    lines = report.classification_report(summary, matrix, labels)
    if result_output:
        report.write_text(lines, result_output)
    return {"scored": scored, "summary": summary, "confusion": matrix, "report": lines,
            "rejected": _counted(spark, test.n_rejected), "rejected_train": _counted(spark, train.n_rejected)}
