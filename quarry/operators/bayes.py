"""Multinomial Naive Bayes on TF-IDF weights (M6, M7, K2, S8 use).

Model, with smoothing a (1.0 in the original), B hash buckets, N training
documents, C classes present, n_c documents and S_cb summed TF-IDF weight of
bucket b in class c, S_c = sum_b S_cb:

    pi_c     = ln(n_c + a) - ln(N + C a)
    theta_cb = ln(S_cb + a) - ln(S_c + B a)
    predict  = argmax_c  pi_c + sum_b v_b theta_cb      (ties -> lowest class)

Training without a per-document shuffle: S_cb = idf_b * (number of tokens of
bucket b in class c), so it is one count per ``(class, bucket)`` (``tfidf.bucket_counts``:
sparse vectors per task, merged by bucket range, in the pass that counts document
frequency) times the idf table (at most B rows). The driver receives only C rows of class statistics.

Scoring: sum_b v_b theta_cb = sum over the document's tokens of
idf_b * theta_cb. A row is a document, whatever its id: the weights of its
buckets are summed where it is, without a shuffle. The weights of a class are B
doubles, a bound fixed by the hashing; as many classes as fit
``quarry.broadcast.maxBoundBytes`` are sent at once, and further classes follow in
further steps. Every document keeps its leading bucket-0 token, so documents
without words are scored by pi alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exactsum import exact_sums
from ..functions.text import NUM_FEATURES, list_slices, with_buckets
from ..session import materialize
from . import manifest
from .sizing import DEFAULT_BOUND_BYTES, broadcast_if_bounded, row_bytes
from .tfidf import BUCKET, bucket_counts, frequencies

PREDICTION = "prediction"


@dataclass
class NaiveBayesModel:
    classes: list[int]              # class indices present in training, ascending
    n_docs: dict[int, int]          # n_c
    pi: dict[int, float]
    totals: dict[int, float]        # S_c
    weights: DataFrame              # (label, bucket, s): S_cb, long form
    idf: DataFrame                  # (bucket, df, idf) of the training documents
    n_train: int
    num_features: int = NUM_FEATURES
    smoothing: float = 1.0

    def log_denominator(self, c: int) -> float:
        return math.log(self.totals[c] + self.num_features * self.smoothing)

    def theta(self) -> DataFrame:
        """(label, bucket, theta) for every (class, bucket) seen in training."""
        denom = F.create_map(*[x for c in self.classes
                               for x in (F.lit(c), F.lit(self.log_denominator(c)))])
        return self.weights.select(
            "label", BUCKET,
            (F.ln(F.col("s") + self.smoothing) - denom[F.col("label")]).alias("theta"))


def labelled_buckets(docs: DataFrame, id_col: str = "doc_id", label_col: str = "label_index",
                     text_col: str = "text", num_features: int = NUM_FEATURES,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, label, *keep, buckets)``: every document tokenised and hashed once."""
    labelled = docs.select(id_col, F.col(label_col).cast("int").alias("label"), *keep, text_col)
    return with_buckets(labelled, text_col, [id_col, "label", *keep], "buckets", num_features)


def fit(train: DataFrame, id_col: str = "doc_id", label_col: str = "label_index",
        text_col: str = "text", smoothing: float = 1.0,
        num_features: int = NUM_FEATURES) -> NaiveBayesModel:
    """Fit on labelled texts (tokenised once, materialized, then ``fit_buckets``)."""
    docs = materialize(labelled_buckets(train, id_col, label_col, text_col, num_features))
    return fit_buckets(docs, smoothing, num_features)


def fit_buckets(docs: DataFrame, smoothing: float = 1.0,
                num_features: int = NUM_FEATURES) -> NaiveBayesModel:
    """Fit on ``(label, buckets)`` rows, e.g. a filter of a materialized
    ``labelled_buckets`` table."""
    counts = {r["label"]: r["n"] for r in
              docs.groupBy("label").agg(F.count("*").alias("n")).collect()}
    classes = sorted(counts)
    n_train = sum(counts.values())
    found = materialize(bucket_counts(docs, "buckets", "label", num_features))      # one pass for both
    df = found.where("label IS NULL").withColumnRenamed("n", "df")
    idf = materialize(df.select(BUCKET, "df", F.ln(F.lit(n_train + 1.0) / (F.col("df") + 1.0))
                                .alias("idf")))
    token_counts = found.where("label IS NOT NULL")
    bounded_idf = broadcast_if_bounded(idf.select(BUCKET, "idf"), num_features, row_bytes(2))
    weights = materialize(token_counts.join(bounded_idf, BUCKET)
                          .select("label", BUCKET, (F.col("n") * F.col("idf")).alias("s")))
    totals = {r["label"]: r["s"] for r in exact_sums(weights, ["s"], ["label"]).collect()}
    log_n = math.log(n_train + len(classes) * smoothing)
    pi = {c: math.log(counts[c] + smoothing) - log_n for c in classes}
    return NaiveBayesModel(classes, counts, pi, {c: totals.get(c, 0.0) for c in classes},
                           weights, idf, n_train, num_features, smoothing)


def score(model: NaiveBayesModel, docs: DataFrame, id_col: str = "doc_id",
          label_col: str = "label_index", text_col: str = "text",
          idf_from: str = "test") -> DataFrame:
    """``(id, label, prediction)`` for every document in ``docs`` (texts are
    tokenised once, materialized, then ``score_buckets``)."""
    bucketed = materialize(labelled_buckets(docs, id_col, label_col, text_col, model.num_features))
    return score_buckets(model, bucketed, id_col, idf_from)


def score_buckets(model: NaiveBayesModel, bucketed: DataFrame, id_col: str = "doc_id",
                  idf_from: str = "test") -> DataFrame:
    """``(id, label, prediction)`` for ``(id, label, buckets)`` rows.

    ``idf_from="test"`` re-fits the idf on the scored documents, as the
    original job does; ``"train"`` applies the training idf (buckets unseen in
    training then get ln(N_train + 1)).
    """
    a, classes = model.smoothing, model.classes
    wide = (model.weights.groupBy(BUCKET)
            .agg(*[F.max(F.when(F.col("label") == c, F.col("s"))).alias(f"s{c}") for c in classes]))
    if idf_from == "test":
        n_docs = bucketed.select(F.count("*")).scalar()
        idf = (frequencies(bucketed, "buckets", model.num_features)
               .select(BUCKET, F.ln((n_docs + 1.0) / (F.col("df") + 1.0)).alias("idf")))
        unseen_idf = 0.0            # not reached: every scored bucket has a test idf
    elif idf_from == "train":
        idf = model.idf
        unseen_idf = math.log(model.n_train + 1.0)
    else:
        raise ValueError(f"idf_from must be 'test' or 'train', not {idf_from!r}")
    per_bucket = idf.select(BUCKET, "idf").join(wide, BUCKET, "left").select(
        BUCKET, *[(F.col("idf") * (F.ln(F.coalesce(F.col(f"s{c}"), F.lit(0.0)) + a)
                                   - F.lit(model.log_denominator(c)))).alias(f"w{c}")
                  for c in classes])
    unseen = {c: unseen_idf * (math.log(a) - model.log_denominator(c)) for c in classes}
    shown = [F.col(c) for c in (id_col, "label")]
    rows = bucketed.select(*shown, "buckets")
    spark = bucketed.sparkSession
    limit = int(spark.conf.get("quarry.broadcast.maxBoundBytes", str(DEFAULT_BOUND_BYTES)))
    together = max(1, limit // (8 * model.num_features))   # classes whose weights are sent at once
    schema = T.StructType([*rows.schema.fields, T.StructField("_z", T.DoubleType()), T.StructField("_c", T.IntegerType())])
    rows = rows.withColumns({"_z": F.lit(None).cast("double"), "_c": F.lit(None).cast("int")})
    per_bucket = materialize(per_bucket) if together < len(classes) else per_bucket
    for i in range(0, len(classes), together):
        some = classes[i:i + together]
        weights = np.array([[unseen[c]] for c in some]) * np.ones(model.num_features)
        table = per_bucket.select(BUCKET, *[f"w{c}" for c in some]).toArrow()   # at most num_features rows
        at = table.column(BUCKET).to_numpy().astype(np.int64)
        for j, c in enumerate(some):
            weights[j, at] = table.column(f"w{c}").to_numpy()
        rows = rows.mapInArrow(_best_class(spark.sparkContext.broadcast(weights), some, [model.pi[c] for c in some]), schema)
    return rows.select(id_col, "label", F.col("_c").alias(PREDICTION))


def _best_class(shared, classes: list[int], priors: list[float]):
    """Sum the weights of each row's buckets and keep the best class so far; ties keep the lower class."""
    def run(batches):
        weights = shared.value
        for batch in (rows for whole in batches for rows in list_slices(whole, "buckets")):
            n = batch.num_rows
            lists = batch.column(batch.schema.get_field_index("buckets"))
            buckets = lists.flatten().to_numpy()
            row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
            z = batch.column(batch.schema.get_field_index("_z")).to_numpy(zero_copy_only=False).astype(np.float64)
            best = np.nan_to_num(batch.column(batch.schema.get_field_index("_c")).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int32)
            z = np.where(np.isnan(z), -np.inf, z)
            for w, c, prior in zip(weights, classes, priors):
                score = prior + np.bincount(row, weights=w[buckets], minlength=n)
                better = score > z
                z, best = np.where(better, score, z), np.where(better, np.int32(c), best)
            kept = batch.columns[:-2]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(z), pa.array(best.astype(np.int32))], names=batch.schema.names)
    return run


def save(model: NaiveBayesModel, path: str, mode: str = "overwrite") -> None:
    """Write the model as Parquet tables (K2), class statistics and weights, and a manifest."""
    spark = model.weights.sparkSession
    classes = spark.createDataFrame(
        [(c, model.n_docs[c], model.pi[c], model.totals[c]) for c in model.classes],
        "label int, n_docs bigint, pi double, total double")
    meta = spark.createDataFrame([(model.n_train, model.num_features, model.smoothing)],
                                 "n_train bigint, num_features int, smoothing double")
    classes.write.mode(mode).parquet(f"{path}/classes")
    meta.write.mode(mode).parquet(f"{path}/meta")
    model.weights.write.mode(mode).parquet(f"{path}/weights")
    model.idf.write.mode(mode).parquet(f"{path}/idf")
    manifest.write(spark, path, "naive_bayes", {"classes": list(model.classes)}, ["classes", "meta", "weights", "idf"])


def load(spark, path: str) -> NaiveBayesModel:
    """Read a model written by ``save`` (S7 analogue for Naive Bayes), checked against its manifest."""
    manifest.read(spark, path, "naive_bayes")
    rows = spark.read.parquet(f"{path}/classes").orderBy("label").collect()
    meta = spark.read.parquet(f"{path}/meta").first()
    classes = [r["label"] for r in rows]
    return NaiveBayesModel(
        classes, {r["label"]: r["n_docs"] for r in rows}, {r["label"]: r["pi"] for r in rows},
        {r["label"]: r["total"] for r in rows}, spark.read.parquet(f"{path}/weights"),
        spark.read.parquet(f"{path}/idf"), meta["n_train"], meta["num_features"], meta["smoothing"])


def fit_native(train: DataFrame, text_col: str = "text", label_col: str = "label_index",
               smoothing: float = 1.0, num_features: int = NUM_FEATURES):
    """Spark ML pipeline: tokens -> HashingTF (Murmur3 buckets) -> IDF -> NaiveBayes."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF

    from ..functions.text import clean_tokens

    prepared = train.withColumn("tokens", clean_tokens(F.col(text_col))) \
                    .withColumn("label", F.col(label_col).cast("double"))
    pipe = Pipeline(stages=[
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features"),
        NaiveBayes(smoothing=smoothing, modelType="multinomial", featuresCol="features",
                   labelCol="label", predictionCol=PREDICTION),
    ])
    return pipe.fit(prepared), prepared
