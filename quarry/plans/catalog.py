"""Name -> query and name -> oracle SQL, as registered with the driver."""

from __future__ import annotations

from ..sources import extract
from . import oracle as O
from . import queries as Q

QUERIES = {
    # extraction
    "q05_features": extract.q05_features,
    "q20_features": extract.q20_features,
    "q25_features": extract.q25_features,
    "q26_features": extract.q26_features,
    "q28_features": extract.q28_features,
    # Q20 / Q25 / Q26: k-means reports (centres + sizes) and costs
    "q20": Q.kmeans_report("q20"),
    "q25": Q.kmeans_report("q25"),
    "q26": Q.kmeans_report("q26"),
    "q20_cost": Q.kmeans_cost("q20"),
    "q25_cost": Q.kmeans_cost("q25"),
    "q26_cost": Q.kmeans_cost("q26"),
    # k-means operator steps (q20 features)
    "kmeans_centers": Q.kmeans_centers("q20"),
    "kmeans_assign": Q.kmeans_assign("q20"),
    "kmeans_sizes": Q.kmeans_sizes("q20"),
    "kmeans_cost": Q.kmeans_cost("q20"),
    "kmeans_gaps": Q.kmeans_gaps,
    "kmeans_cost_small": Q.kmeans_cost("q20_small"),
    "kmeans_best_of": Q.kmeans_best_of,
    "kmeans_run_costs": Q.kmeans_run_costs,
    "cluster_lines": Q.cluster_lines,
    "embeddings_kmeans": Q.embeddings_kmeans,
    "embeddings_kmeans_cost": Q.kmeans_cost("embeddings"),
    "parse_space_embeddings": Q.parse_space_embeddings,
    # Q28: text cleaning, hashed TF-IDF, Naive Bayes, report
    "tokenize": Q.tokenize,
    "stopword_filter": Q.stopword_filter,
    "hash_tf": Q.hash_tf,
    "idf": Q.idf,
    "tfidf": Q.tfidf_weights,
    "nb_train": Q.nb_train,
    "nb_theta": Q.nb_theta,
    "nb_score": Q.nb_score,
    "nb_score_train_idf": Q.nb_score_train_idf,
    "nb_summary": Q.nb_summary,
    "nb_confusion": Q.nb_confusion,
    "q28": Q.q28,
    "nb_score_folded": Q.nb_score_folded,
    "report_wide": Q.report_wide,
    "report_text": Q.report_text,
    # Q05: logistic regression
    "logistic_train": Q.logistic_train,
    "logistic_train_small_lambda": Q.logistic_train_small_lambda,
    "logistic_train_with_label": Q.logistic_train_with_label,
    "logistic_score": Q.logistic_score,
    "logistic_accuracy": Q.logistic_accuracy,
    "logistic_confusion": Q.logistic_confusion,
    "logistic_auc": Q.logistic_auc,
    "logistic_train_embeddings": Q.logistic_train_embeddings,
    "logistic_score_embeddings": Q.logistic_score_embeddings,
    "q05": Q.q05,
    # S3-S5 readers over lines built from the tables
    "parse_comma": Q.parse_comma,
    "parse_comma_rejects": Q.parse_comma_rejects,
    "parse_observed": Q.parse_observed,
    "read_rejects": Q.read_rejects,
    "parse_space": Q.parse_space,
    "parse_space_drop": Q.parse_space_drop,
    "parse_space_rejects": Q.parse_space_rejects,
    "parse_space_totals": Q.parse_space_totals,
    "read_vector_files": Q.read_vector_files,
    "parse_tab": Q.parse_tab,
    "parse_tab_rejects": Q.parse_tab_rejects,
    # Model save and load
    "logistic_roundtrip": Q.logistic_roundtrip,
    "nb_roundtrip": Q.nb_roundtrip,
}


def _cluster_sql(query: str, kind: str) -> str:
    spec = Q.CLUSTER_SPECS[query]
    small = "SELECT c_custkey, " + ", ".join(f"{c} * 0.001::DOUBLE AS {c}" for c in Q.CLUSTER_SPECS["q20"].cols) + f" FROM ({O.Q20_FEATURES})"
    features = {"q20": O.Q20_FEATURES, "q20_small": small, "q25": O.Q25_FEATURES, "q26": O.q26_features_sql(),
                "embeddings": O.embedding_features_sql()}[query]
    return O.kmeans_sql(kind, features, spec.id_col, spec.cols, Q.KMEANS_K, Q.KMEANS_ITERATIONS,
                        spec.scale)


def oracle_sql() -> dict[str, str]:
    sql = {
        "q05_features": O.Q05_FEATURES,
        "q20_features": O.Q20_FEATURES,
        "q25_features": O.Q25_FEATURES,
        "q26_features": O.q26_features_sql(),
        "q28_features": O.Q28_DOCUMENTS,
    }
    for q in ("q20", "q25", "q26"):
        sql[q] = _cluster_sql(q, "report")
        sql[f"{q}_cost"] = _cluster_sql(q, "cost")
    shown = ", ".join(f"round(x{i} * 1e9::DOUBLE) / 1e9::DOUBLE AS x{i}" for i in range(O.VECTOR_WIDTH))
    sql["embeddings_kmeans"] = f"SELECT cluster_id, {shown}, n FROM ({_cluster_sql('embeddings', 'report')})"
    spec = Q.CLUSTER_SPECS["q20"]
    runs = (O.Q20_FEATURES, spec.id_col, spec.cols, 3)
    sql["kmeans_best_of"] = O.kmeans_best_of_sql(*runs)
    sql["kmeans_run_costs"] = O.kmeans_run_costs_sql(*runs)
    sql["cluster_lines"] = O.cluster_lines_sql(_cluster_sql("q20", "report"), spec.cols)
    for kind in ("train", "score"):
        sql[f"logistic_{kind}_embeddings"] = O.vector_logistic_sql(kind, Q.Q05_PASSES, Q.Q05_RATE, 0.001)
    sql["embeddings_kmeans_cost"] = _cluster_sql("embeddings", "cost")
    sql["parse_space_embeddings"] = O.parse_space_embeddings_sql()
    sql["kmeans_centers"] = _cluster_sql("q20", "centers")
    sql["kmeans_assign"] = _cluster_sql("q20", "assign")
    sql["kmeans_sizes"] = _cluster_sql("q20", "sizes")
    sql["kmeans_cost"] = _cluster_sql("q20", "cost")
    sql["kmeans_cost_small"] = _cluster_sql("q20_small", "cost")
    gaps = f"SELECT * FROM ({O.Q20_FEATURES}) WHERE c_custkey % 41 <> 0 AND c_custkey % 43 <> 0"
    spec = Q.CLUSTER_SPECS["q20"]
    sql["kmeans_gaps"] = O.kmeans_sql("sizes", gaps, spec.id_col, spec.cols, Q.KMEANS_K, Q.KMEANS_ITERATIONS, spec.scale) + (
        f" UNION ALL SELECT -1, count(*) FROM ({O.Q20_FEATURES}) WHERE c_custkey % 41 = 0 OR c_custkey % 43 = 0")
    sql["report_wide"] = O.wide_report_sql()
    sql["report_text"] = f"SELECT line AS value FROM ({O.wide_report_sql()})"
    sql["nb_score_folded"] = f"SELECT doc_id % 50 AS doc_id, label, prediction FROM ({O.nb_sql('score')})"
    sql["tokenize"] = O.TOKENIZE
    sql["stopword_filter"] = O.stopword_filter_sql()
    sql["hash_tf"] = O.hash_tf_sql()
    sql["idf"] = O.idf_sql()
    sql["tfidf"] = O.tfidf_sql()
    for kind in ("train", "theta", "score", "summary", "confusion"):
        sql[f"nb_{kind}"] = O.nb_sql(kind)
    sql["nb_score_train_idf"] = O.nb_sql("score", idf_from="train")
    sql["q28"] = O.nb_sql("report")

    def lr(kind, lam=Q.Q05_LAMBDA, cols=Q.Q05_FEATURES):
        return O.logistic_sql(kind, O.Q05_FEATURES, "c_customer_sk", cols, Q.Q05_PASSES, Q.Q05_RATE, lam)
    sql["logistic_train"] = lr("train")
    sql["logistic_train_small_lambda"] = lr("train", Q.Q05_SMALL_LAMBDA)
    sql["logistic_train_with_label"] = lr("train", cols=Q.Q05_FEATURES + ["label"])
    for kind in ("score", "accuracy", "confusion", "auc"):
        sql[f"logistic_{kind}"] = lr(kind, Q.Q05_SMALL_LAMBDA)
    sql["q05"] = lr("report")
    sql["logistic_roundtrip"] = sql["logistic_score"]
    sql["nb_roundtrip"] = sql["nb_score"]
    sql["parse_comma"] = O.parse_comma_sql("good")
    sql["parse_comma_rejects"] = O.parse_comma_sql("rejects")
    sql["parse_observed"] = O.parse_observed_sql()
    sql["read_rejects"] = O.read_rejects_sql()
    sql["parse_space"] = O.parse_space_sql(False)
    sql["parse_space_drop"] = O.parse_space_sql(True)
    sql["parse_space_rejects"] = O.parse_space_rejects_sql()
    sql["read_vector_files"] = O.parse_space_sql(False)
    lines = f"(SELECT count(*) FROM ({O.Q20_FEATURES})) + (SELECT count(*) FROM ({O.Q20_FEATURES}) WHERE returns = 0)"
    sql["parse_space_totals"] = (f"SELECT {lines} AS n_lines, (SELECT count(*) FROM ({O.parse_space_sql(True)})) AS n_kept, "
                                 f"(SELECT n_rejected FROM ({O.parse_space_rejects_sql()})) AS n_rejected")
    sql["parse_tab"] = O.parse_tab_sql("good")
    sql["parse_tab_rejects"] = O.parse_tab_sql("rejects")
    return {k: v for k, v in sql.items() if k in QUERIES}
