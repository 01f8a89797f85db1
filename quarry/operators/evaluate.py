"""Evaluation of scored rows (A1-A7, P8-P11, D2): all aggregation in Spark.

Inputs are DataFrames with an integer/double ``label`` and ``prediction``
column (J1/J2: the pair lives on one row, so nothing is zipped). Outputs are
small DataFrames; nothing is collected to build them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed
from ..session import materialize
from .sizing import broadcast_if_bounded


def _labels_frame(spark, labels: list[str]) -> DataFrame:
    # The label dictionary: a handful of fixed rows (bounded), safe to broadcast.
    return spark.createDataFrame([(i, name) for i, name in enumerate(labels)],
                                 "label int, label_name string")


def accuracy(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows with prediction = label (A7; the original prints it as "AUC")."""
    return scored.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def summary(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Correct, incorrect, total and percentages (A1-A3).

    Percentages are rounded half-even to 4 places, as the original number
    format does; 0 rows give NULL percentages instead of NaN.
    """
    counts = scored.agg(F.count_if(F.col(prediction) == F.col(label)).alias("correct"),
                        F.count("*").alias("total"))
    return counts.select(
        "correct",
        (F.col("total") - F.col("correct")).alias("incorrect"),
        "total",
        F.bround(F.try_divide(100.0 * F.col("correct"), F.col("total")), 4).alias("pct_correct"),
        F.bround(F.try_divide(100.0 * (F.col("total") - F.col("correct")), F.col("total")), 4)
        .alias("pct_incorrect"),
    )


def confusion_long(scored: DataFrame, label: str = "label",
                   prediction: str = "prediction", classes: tuple[int, ...] = (0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of ``classes``, zeros included (A4/A6 long form)."""
    counts = (scored.groupBy(F.col(label).cast("int").alias("actual"),
                             F.col(prediction).cast("int").alias("predicted"))
              .agg(F.count("*").alias("n")))
    cells = scored.sparkSession.createDataFrame([(a, p) for a in classes for p in classes], "actual int, predicted int")
    counts = broadcast_if_bounded(counts, len(classes) ** 2, 32)
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def confusion_matrix(scored: DataFrame, labels: list[str], label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """One row per actual class: label, label_name, one count column per
    predicted class (named after the labels) and the row total (A4, A5).
    Classes without test rows still get their row of zeros."""
    names = list(labels)
    pivot = (scored.select(F.col(label).cast("int").alias("label"),
                           F.col(prediction).cast("int").alias("predicted"))
             .groupBy("label").pivot("predicted", list(range(len(names)))).count())
    pivot = pivot.select("label", *[F.col(str(i)).alias(n) for i, n in enumerate(names)])
    dims = _labels_frame(scored.sparkSession, names)
    out = dims.join(broadcast_if_bounded(pivot, len(names), 16 + 8 * len(names)), "label", "left").select(
        "label", "label_name",
        *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in names])
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return out.withColumn("total", total)


def auc(scored: DataFrame, score: str = "probability", label: str = "label",
        digits: int = 6) -> DataFrame:
    """Exact area under the ROC curve (D2), ties counted one half.

    AUC = sum over distinct scores s of pos(s) * (neg below s + neg(s) / 2) / (P * N).
    Rows are first reduced to one row per distinct score (partial aggregation,
    so a score shared by a third of all rows is one row), then the running
    count of negatives is computed in a distributed way: range-partition the
    distinct scores, total each partition, offset each partition by the
    totals of the partitions before it (one row per partition, broadcast),
    and run the cumulative sum within each partition. The distinct-score table
    is materialized, so it is computed once.
    """
    spark = scored.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by_score = (scored.groupBy(F.col(score).alias("s"))
                .agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"),
                     F.sum((F.col(label) != 1).cast("long")).alias("neg")))
    # written once, so the partition totals and the running sums see the same partition ids
    ranged = materialize(by_score.repartitionByRange(parts, "s").withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("neg").alias("part_neg"))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_neg").over(Window.orderBy("part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    offsets = broadcast_if_bounded(offsets, parts, 24)
    within = Window.partitionBy("part").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    cum = (ranged.join(offsets, "part")
           .withColumn("neg_below", F.col("offset") + F.coalesce(F.sum("neg").over(within), F.lit(0))))
    return cum.agg(fixed(F.try_divide(
        F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
        F.sum("pos").cast("double") * F.sum("neg")), digits).alias("auc"))
