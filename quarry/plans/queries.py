"""The registered queries: q05, q20, q25, q26, q28 and their operator steps.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame built from
the tables under ``sf_dir``. Iterative fits run their rounds as Spark jobs
inside the call (the driver only sees model-sized state) and return a lazy
DataFrame over the fitted model.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.numeric import fixed
from ..operators import bayes, evaluate, kmeans, logistic, report, tfidf
from ..session import materialize, shared_path
from ..sources import extract, readers
from ..sources.tables import table

# Fixed run settings of the original k-means jobs: k, iterations, runs.
KMEANS_K = 8
KMEANS_ITERATIONS = 10
KMEANS_RUNS = 1


@dataclass(frozen=True)
class ClusterSpec:
    features: Callable[[SparkSession, str], DataFrame]
    id_col: str
    cols: tuple[str, ...]
    scale: int | None   # decimals the features carry; None: means of the doubles themselves


CLUSTER_SPECS = {
    "q20": ClusterSpec(extract.q20_features, "c_custkey",
                       ("order_ratio", "item_ratio", "amount_ratio", "returns"), 6),
    "q25": ClusterSpec(extract.q25_features, "c_custkey", ("recency", "frequency", "monetary"), 3),
    "q26": ClusterSpec(extract.q26_features, "c_custkey",
                       tuple(f"n_{t.lower()}" for t in extract.Q26_TYPES), 0),
    "q20_small": ClusterSpec(lambda s, d: q20_small_features(s, d), "c_custkey",
                             ("order_ratio", "item_ratio", "amount_ratio", "returns"), 9),
    "embeddings": ClusterSpec(extract.embedding_features, "vec_id",
                              tuple(f"x{i}" for i in range(extract.EMBEDDING_DIMS)), None),
}
EMBEDDING_DIGITS = 9    # centres of ``embeddings`` are shown with so many decimals
BEST_OF_RUNS = 3


def cluster_fit(spark: SparkSession, sf_dir: str, query: str, k: int = KMEANS_K,
                iterations: int = KMEANS_ITERATIONS):
    """Extract, materialize and fit; returns (assigned points, model)."""
    spec = CLUSTER_SPECS[query]
    pts = materialize(spec.features(spark, sf_dir).select(spec.id_col, *spec.cols))
    model = kmeans.fit(pts, spec.id_col, list(spec.cols), k=k, max_iter=iterations,
                       materialized=True, exact_scale=spec.scale)
    return kmeans.assign(pts, model), model


def kmeans_report(query: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        assigned, model = cluster_fit(spark, sf_dir, query)
        return kmeans.report(assigned, model)
    return run


def kmeans_cost(query: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        assigned, _ = cluster_fit(spark, sf_dir, query)
        return kmeans.cost(assigned)
    return run


def kmeans_sizes(query: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        assigned, model = cluster_fit(spark, sf_dir, query)
        return kmeans.cluster_sizes(assigned, model.k)
    return run


def kmeans_assign(query: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        assigned, _ = cluster_fit(spark, sf_dir, query)
        spec = CLUSTER_SPECS[query]
        return assigned.select(spec.id_col, kmeans.CLUSTER)
    return run


def kmeans_centers(query: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, model = cluster_fit(spark, sf_dir, query)
        return kmeans.centers_frame(spark, model)
    return run


def q20_small_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q20 features a thousandth of their size: distances far below the third decimal."""
    return extract.q20_features(spark, sf_dir).select(
        "c_custkey", *[(F.col(c) * F.lit(0.001)).alias(c) for c in ("order_ratio", "item_ratio", "amount_ratio", "returns")])


def kmeans_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster sizes of the q20 features when each 41st customer's amount ratio is NaN and each 43rd's is
    null; these customers are counted under cluster -1."""
    amount = F.when(F.col("c_custkey") % 41 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 43 == 0, None).otherwise(F.col("amount_ratio"))
    spec = CLUSTER_SPECS["q20"]
    pts = materialize(extract.q20_features(spark, sf_dir).select(spec.id_col, *spec.cols).withColumn("amount_ratio", amount))
    model = kmeans.fit(pts, spec.id_col, list(spec.cols), k=KMEANS_K, max_iter=KMEANS_ITERATIONS, materialized=True, exact_scale=spec.scale)
    assigned = kmeans.assign(pts, model)
    return kmeans.cluster_sizes(assigned, model.k).unionByName(
        kmeans.unplaced(assigned).select(F.lit(-1).alias(kmeans.CLUSTER), F.col("n_unplaced").alias("n")))


def embeddings_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres and sizes of the embedding vectors; means of the values as they are, rounded only to be shown."""
    assigned, model = cluster_fit(spark, sf_dir, "embeddings")
    shown = kmeans.report(assigned, model)
    return shown.select(kmeans.CLUSTER, *[fixed(F.col(c), EMBEDDING_DIGITS).alias(c) for c in model.feature_cols], "n")


def best_of_fit(spark: SparkSession, sf_dir: str):
    spec = CLUSTER_SPECS["q20"]
    pts = materialize(spec.features(spark, sf_dir).select(spec.id_col, *spec.cols))
    return pts, kmeans.fit_best_of(pts, spec.id_col, list(spec.cols), k=KMEANS_K, max_iter=KMEANS_ITERATIONS, runs=BEST_OF_RUNS,
                                   seed=1, exact_scale=spec.scale, init="salted", materialized=True)


def kmeans_best_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres and sizes of the best of three runs from salted starts (D11, the original's ``runs``)."""
    pts, model = best_of_fit(spark, sf_dir)
    return kmeans.report(kmeans.assign(pts, model), model)


def kmeans_run_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost of each of the three runs, to 10 significant digits."""
    _, model = best_of_fit(spark, sf_dir)
    rows = spark.createDataFrame(list(enumerate(model.run_costs)), "run int, cost double")
    return rows.select("run", kmeans.significant(F.col("cost"), 10).alias("cost"))


def cluster_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q20 cluster report as text lines, centres with six decimals."""
    assigned, model = cluster_fit(spark, sf_dir, "q20")
    return report.cluster_lines(kmeans.report(assigned, model), model.feature_cols, decimals=6)


# ------------------------------------------------------------- q28: text

LABELS = list(extract.Q28_LABELS)


def label_index(label, labels=LABELS):
    """Position of the label in the label list, -1 when unknown."""
    return (F.array_position(F.array(*[F.lit(x) for x in labels]), label) - 1).cast("int")


def q28_sets(spark: SparkSession, sf_dir: str):
    """(train, test) labelled documents with ``label_index``; unknown labels are
    left out (D6) - with this extraction there are none."""
    known = q28_labelled(spark, sf_dir)
    return known.where(F.col("split") == "train"), known.where(F.col("split") == "test")


def q28_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All labelled documents with a known label: doc_id, label, label_index, text, split."""
    docs = extract.q28_documents(spark, sf_dir).withColumn("label_index", label_index(F.col("label")))
    return docs.where(F.col("label_index") >= 0)


def q28_buckets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) ``(doc_id, label, split, buckets)`` rows. The labelled
    documents are read, joined and tokenised once into one materialized table;
    the two sets are filters on it."""
    bucketed = materialize(bayes.labelled_buckets(q28_labelled(spark, sf_dir), keep=("split",)))
    return bucketed.where(F.col("split") == "train"), bucketed.where(F.col("split") == "test")


def nb_fit(spark: SparkSession, sf_dir: str) -> bayes.NaiveBayesModel:
    train, _ = q28_buckets(spark, sf_dir)
    return bayes.fit_buckets(train)


def nb_fit_score(spark: SparkSession, sf_dir: str, idf_from: str = "test"):
    train, test = q28_buckets(spark, sf_dir)
    model = bayes.fit_buckets(train)
    return model, bayes.score_buckets(model, test, idf_from=idf_from)


def nb_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class statistics of the fitted model: documents, log prior, TF-IDF total.

    The total is a sum over millions of weights whose last digits depend on the
    summation order, so it is reported to 2 decimals (the log prior to 6).
    """
    model = nb_fit(spark, sf_dir)
    rows = [(c, LABELS[c], model.n_docs[c], model.pi[c], model.totals[c]) for c in model.classes]
    return spark.createDataFrame(rows, "label int, label_name string, n_docs bigint, pi double, total double") \
        .select("label", "label_name", "n_docs", fixed(F.col("pi"), 6).alias("pi"),
                fixed(F.col("total"), 2).alias("total"))


def nb_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """theta for every (class, bucket) seen in training."""
    model = nb_fit(spark, sf_dir)
    return model.theta().select("label", "bucket", fixed(F.col("theta"), 6).alias("theta"))


def nb_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = nb_fit_score(spark, sf_dir)
    return scored


def nb_score_train_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring with the training idf instead of one re-fitted on the test set."""
    _, scored = nb_fit_score(spark, sf_dir, idf_from="train")
    return scored


def nb_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = nb_fit_score(spark, sf_dir)
    return evaluate.summary(scored)


def nb_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = nb_fit_score(spark, sf_dir)
    return evaluate.confusion_matrix(scored, LABELS)


def q28(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q28 classification report as numbered text lines."""
    _, scored = nb_fit_score(spark, sf_dir)
    scored = materialize(scored)
    return report.classification_report(evaluate.summary(scored),
                                        evaluate.confusion_matrix(scored, LABELS), LABELS)


def nb_score_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring when ids repeat: every row is a document of its own, whatever its id."""
    train, test = q28_buckets(spark, sf_dir)
    folded = test.withColumn("doc_id", F.col("doc_id") % 50)
    return bayes.score_buckets(bayes.fit_buckets(train), folded)


def report_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classification report over order lines, weighted by quantity in hundredths: counts of any length."""
    names = ["A", "N", "R"]
    lines = table(spark, sf_dir, "lineitem", "l_returnflag", "l_linenumber", "l_quantity")
    cells = lines.groupBy(label_index(F.col("l_returnflag"), names).alias("label"), (F.col("l_linenumber") % 3).alias("p")).agg(
        F.sum(F.round(F.col("l_quantity") * 100).cast("bigint")).alias("n"))
    right = F.sum(F.when(F.col("label") == F.col("p"), F.col("n")).otherwise(0))
    totals = cells.agg(right.alias("correct"), F.sum("n").alias("total"))
    summary = totals.select("correct", (F.col("total") - F.col("correct")).alias("incorrect"), "total",
                            F.bround(100.0 * F.col("correct") / F.col("total"), 4).alias("pct_correct"),
                            F.bround(100.0 * (F.col("total") - F.col("correct")) / F.col("total"), 4).alias("pct_incorrect"))
    matrix = cells.groupBy("label").agg(
        *[F.coalesce(F.sum(F.when(F.col("p") == i, F.col("n"))), F.lit(0)).alias(c) for i, c in enumerate(names)],
        F.sum("n").alias("total")).withColumn("label_name", F.element_at(F.array(*map(F.lit, names)), F.col("label") + 1))
    return report.classification_report(summary, matrix, names)


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report written as text and read back."""
    path = shared_path(spark, "reports")
    report.write_text(report.require_rows(report_wide(spark, sf_dir), "the report"), path)
    return readers.read_lines(spark, path)


def read_vector_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q20 vectors written as a folder of part files and read back as vectors."""
    path = shared_path(spark, "vectors")
    readers.write_space(extract.q20_features(spark, sf_dir).repartition(3), path, Q20_COLS)
    good, _ = readers.read_space(spark, path, width=len(Q20_COLS))
    return readers.vector_columns(good, len(Q20_COLS))


def parse_space_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is lost: lines in, vectors kept and lines rejected, counted by one job over the lines."""
    parsed = readers.observe_space(space_lines(spark, sf_dir, True), mode="drop", width=len(Q20_COLS))
    n_kept = materialize(parsed.good).count()
    return spark.createDataFrame([(parsed.n_lines, n_kept, parsed.n_rejected)], "n_lines bigint, n_kept bigint, n_rejected bigint")


def parse_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept comma records with the number of lines and of rejected ones, all from the one job that wrote the records."""
    parsed = readers.observe_comma(comma_lines(spark, sf_dir))
    good = materialize(parsed.good)
    return good.withColumns({"n_lines": F.lit(parsed.n_lines).cast("bigint"), "n_rejected": F.lit(parsed.n_rejected).cast("bigint")})


def read_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected lines of a folder of files, found again by file and line number (S1, S2, S6). The files hold the
    comma lines by the last character of their key, each in the order of its lines."""
    path = shared_path(spark, "lines")
    numbered = comma_lines(spark, sf_dir).select("value", F.substring(F.split("value", ",")[0], -1, 1).alias("digit"))
    numbered.repartition(4, "digit").sortWithinPartitions("digit", "value").write.partitionBy("digit").text(path)
    found = readers.located_rejects(spark, path, readers.flag_comma)
    return found.select(F.regexp_extract("file", "digit=([^/]*)/", 1).alias("digit"), "line_no", "line", "is_header")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased letter runs of every document."""
    return _documents(spark, sf_dir).select("doc_id", T.raw_tokens(F.col("text")).alias("tokens")).select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.concat_ws(" ", "tokens").alias("tokens"))


def stopword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text after stop-word removal, as the original cleaning step returns it."""
    return _documents(spark, sf_dir).select(
        "doc_id", F.size(T.clean_tokens(F.col("text"))).cast("bigint").alias("n_kept"),
        T.cleaned_text(F.col("text")).alias("cleaned"))


def hash_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.term_frequency(_documents(spark, sf_dir))


def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.idf_table(_documents(spark, sf_dir)).select(
        "bucket", "df", fixed(F.col("idf"), 6).alias("idf"))


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tfidf.tfidf(_documents(spark, sf_dir)).select(
        "doc_id", "bucket", fixed(F.col("tfidf"), 6).alias("tfidf"))


# ---------------------------------------------------------- q05: logistic


# Fixed run settings of the original q05 job: passes, rate, L1 lambda.
Q05_PASSES = 20
Q05_RATE = 1.0
Q05_LAMBDA = 0.1
Q05_FEATURES = ["flag_balance", "flag_segment"]
# A second, lightly penalised fit, so the weights are not all shrunk to zero.
Q05_SMALL_LAMBDA = 0.001


def logistic_fit_score(spark: SparkSession, sf_dir: str, lam: float = Q05_LAMBDA,
                       feature_cols=None):
    return _fit_score(materialize(extract.q05_features(spark, sf_dir)), lam, feature_cols)


def _fit_score(data: DataFrame, lam: float, feature_cols=None):
    cols = list(feature_cols or Q05_FEATURES)
    model = logistic.fit(data, cols, "label", passes=Q05_PASSES, rate=Q05_RATE, lam=lam, grouped=True)
    return model, logistic.score(model, data, keep=("c_customer_sk",))


def logistic_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = logistic_fit_score(spark, sf_dir)
    return logistic.weights_frame(spark, model)


def logistic_train_small_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = logistic_fit_score(spark, sf_dir, lam=Q05_SMALL_LAMBDA)
    return logistic.weights_frame(spark, model)


def logistic_train_with_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parity fit with the label also fed in as a third feature, as the original does."""
    model, _ = logistic_fit_score(spark, sf_dir, feature_cols=Q05_FEATURES + ["label"])
    return logistic.weights_frame(spark, model)


def logistic_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = logistic_fit_score(spark, sf_dir, lam=Q05_SMALL_LAMBDA)
    return scored.select("c_customer_sk", "label", fixed(F.col("probability"), 6).alias("probability"),
                         "prediction")


def logistic_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = logistic_fit_score(spark, sf_dir, lam=Q05_SMALL_LAMBDA)
    return evaluate.accuracy(scored).select(fixed(F.col("accuracy"), 6).alias("accuracy"))


def logistic_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = logistic_fit_score(spark, sf_dir, lam=Q05_SMALL_LAMBDA)
    return evaluate.confusion_long(scored)


def logistic_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = logistic_fit_score(spark, sf_dir, lam=Q05_SMALL_LAMBDA)
    return evaluate.auc(scored, "probability")


# Continuous features: the embedding vectors against a 0/1 label.
EMBEDDING_LAMBDA = 0.001


def embedding_fit(spark: SparkSession, sf_dir: str):
    data = extract.embedding_labels(spark, sf_dir)
    return data, logistic.fit_vectors(data, "features", "label", passes=Q05_PASSES, rate=Q05_RATE, lam=EMBEDDING_LAMBDA,
                                      width=extract.EMBEDDING_DIMS)


def logistic_train_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a fit on 64 continuous features; no pass exchanges rows (M1)."""
    _, model = embedding_fit(spark, sf_dir)
    return logistic.weights_frame(spark, model)


def logistic_score_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and prediction of every vector under that fit (M2)."""
    data, model = embedding_fit(spark, sf_dir)
    return logistic.score(model, data, keep=("vec_id",)).select(
        "vec_id", "label", fixed(F.col("probability"), 6).alias("probability"), "prediction")


def q05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The q05 result at the original settings, as metric rows: the accuracy
    (which the original prints as "AUC", two decimals; actual = predicted =
    -1 on that row) and one row per (actual, predicted) confusion cell."""
    _, scored = logistic_fit_score(spark, sf_dir)
    matrix = evaluate.confusion_long(scored)
    right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    acc = matrix.agg(F.try_divide(right.cast("double"), F.sum("n")).alias("accuracy")).select(
        F.lit("accuracy").alias("metric"), F.lit(-1).alias("actual"),
        F.lit(-1).alias("predicted"), fixed(F.col("accuracy"), 6).alias("value"),
        F.format_string("%.2f", F.col("accuracy")).alias("text"))
    cells = matrix.select(
        F.lit("confusion").alias("metric"), "actual", "predicted",
        F.col("n").cast("double").alias("value"), F.lit("").alias("text"))
    return acc.unionByName(cells)


# ------------------------------------------------------ readers


_HEADER = ",".join(readers.COMMA_FIELDS)


def comma_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """q05 records as comma lines, plus variants driven by the data: a header
    line, an extra line with an empty field for every customer with a negative
    balance, an extra 3-field line for HOUSEHOLD customers, and blanks around
    field 1 for FURNITURE customers."""
    feats = extract.q05_features(spark, sf_dir)
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment")
    rows = feats.join(cust, F.col("c_customer_sk") == F.col("c_custkey"))
    s = lambda c: F.col(c).cast("string")
    f1 = F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit(" "), s("flag_balance"), F.lit(" "))) \
        .otherwise(s("flag_balance"))
    main = F.concat_ws(",", s("c_customer_sk"), f1, s("flag_segment"), s("label"))
    empty = F.when(F.col("c_acctbal") < 0, F.concat_ws(",", s("c_customer_sk"), F.lit(""), s("flag_segment"), s("label")))
    short = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat_ws(",", s("c_customer_sk"), s("flag_balance"), s("flag_segment")))
    lines = rows.select(F.explode(F.array_compact(F.array(main, empty, short))).alias("value"))     # one read of the rows
    return lines.unionByName(spark.range(1).select(F.lit(_HEADER).alias("value")))


def parse_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.parse_comma(comma_lines(spark, sf_dir))
    return good


def parse_comma_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = readers.parse_comma(comma_lines(spark, sf_dir))
    return rejected.agg(F.count("*").alias("n_rejected"))


Q20_COLS = list(CLUSTER_SPECS["q20"].cols)


def space_lines(spark: SparkSession, sf_dir: str, with_bad: bool = False) -> DataFrame:
    """q20 vectors as blank-separated lines; customers without returns get a
    trailing blank. With ``with_bad``, those customers also get a line with a
    doubled blank (an empty token)."""
    feats = extract.q20_features(spark, sf_dir)
    vals = [F.col(c).cast("string") for c in Q20_COLS]
    no_returns = F.col("returns") == 0
    line = F.concat_ws(" ", *vals)
    main = feats.select(F.when(no_returns, F.concat(line, F.lit(" "))).otherwise(line).alias("value"))
    if not with_bad:
        return main
    bad = feats.where(no_returns).select(F.concat_ws("  ", *vals).alias("value"))
    return main.unionByName(bad)


def parse_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.parse_space(space_lines(spark, sf_dir), mode="strict", width=len(Q20_COLS))
    return readers.vector_columns(good, len(Q20_COLS))


def parse_space_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.parse_space(space_lines(spark, sf_dir, True), mode="drop", width=len(Q20_COLS))
    return readers.vector_columns(good, len(Q20_COLS))


def parse_space_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = readers.parse_space(space_lines(spark, sf_dir, True), mode="drop", width=len(Q20_COLS))
    return rejected.agg(F.count("*").alias("n_rejected"))


def parse_space_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 64-wide embedding vectors written as blank-separated lines and parsed back."""
    emb = table(spark, sf_dir, "embeddings", "embedding")
    lines = emb.select(F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")),
                                    " ").alias("value"))
    good, _ = readers.parse_space(lines, mode="strict", width=extract.EMBEDDING_DIMS)
    return readers.vector_columns(good, extract.EMBEDDING_DIMS)


def tab_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as tab lines; German ones get a trailing tab (kept),
    French ones a lower-case label (rejected), Spanish ones a fourth field
    (rejected)."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    label = (F.when(F.col("toxic") == 1, F.lit("NEG")).when(F.col("quality") == 1, F.lit("POS"))
             .otherwise(F.lit("NEU")))
    label = F.when(F.col("lang") == "fr", F.lower(label)).otherwise(label)
    text = F.regexp_replace(F.col("text"), "[\t\r\n]+", " ")
    line = F.concat_ws("\t", F.col("doc_id").cast("string"), label, text)
    line = (F.when(F.col("lang") == "de", F.concat(line, F.lit("\t")))
            .when(F.col("lang") == "es", F.concat(line, F.lit("\tx")))
            .otherwise(line))
    return docs.join(labels, "doc_id").select(line.alias("value"))


def parse_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.parse_tab(tab_lines(spark, sf_dir), LABELS)
    return good


def parse_tab_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = readers.parse_tab(tab_lines(spark, sf_dir), LABELS)
    return rejected.agg(F.count("*").alias("n_rejected"))


# ------------------------------------------------- model save / load


def logistic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, then score with the loaded model; equals logistic_score."""
    data = materialize(extract.q05_features(spark, sf_dir))
    model, _ = _fit_score(data, Q05_SMALL_LAMBDA)
    path = shared_path(spark, "models", "logistic")
    logistic.save(model, path)
    loaded = logistic.load(spark, path)
    scored = logistic.score(loaded, data, keep=("c_customer_sk",))
    return scored.select("c_customer_sk", "label", fixed(F.col("probability"), 6).alias("probability"),
                         "prediction")


def nb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load, then score the test set with the loaded model; equals nb_score."""
    train, test = q28_buckets(spark, sf_dir)
    path = shared_path(spark, "models", "naive_bayes")
    bayes.save(bayes.fit_buckets(train), path)
    return bayes.score_buckets(bayes.load(spark, path), test)
