"""File-based jobs: write the three text shapes from the tables, run the jobs,
and compare with the DataFrame-based queries."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import logistic
from quarry.plans import jobs
from quarry.plans import queries as Q
from quarry.sources import extract, readers

from paths import SF_SMALL


def test_logistic_jobs(spark, tmp_path):
    feats = extract.q05_features(spark, SF_SMALL).select(
        "c_customer_sk", F.col("flag_balance").alias("college_education"),
        F.col("flag_segment").alias("male"), "label")
    readers.write_comma(feats, str(tmp_path / "in"))
    model = jobs.train_logistic(spark, str(tmp_path / "in"), str(tmp_path / "model"),
                                passes=20, lam=0.001, rate=1.0)
    direct = logistic.fit(feats, ["college_education", "male"], "label", 20, 1.0, 0.001)
    assert model.weights == direct.weights and model.intercept == direct.intercept
    out = jobs.run_logistic(spark, str(tmp_path / "in"), str(tmp_path / "model"))
    assert out["rejected"].first().n_rejected == 0
    assert sum(r.n for r in out["confusion"].collect()) == feats.count()
    assert 0.0 <= out["auc"].first().auc <= 1.0


def test_kmeans_job(spark, tmp_path):
    feats = extract.q20_features(spark, SF_SMALL)
    cols = list(Q.CLUSTER_SPECS["q20"].cols)
    readers.write_space(feats, str(tmp_path / "in"), cols)
    out = jobs.run_kmeans(spark, str(tmp_path / "in"), str(tmp_path / "out"), k=8, max_iteration=10, runs=2)
    clusters = out["clusters"].collect()
    assert len(clusters) == 8 and sum(r.n for r in clusters) == feats.count()
    whole = "".join(r.value for r in spark.read.text(str(tmp_path / "out"), wholetext=True).collect())
    lines = whole.split("\r\n")
    assert lines[-1] == "" and len(lines) == 9
    assert [line.split(" ")[1] for line in lines[:-1]] == [str(i) for i in range(8)]
    assert out["cost"].first().cost > 0


def test_kmeans_job_rejects_ragged_input(spark, tmp_path):
    spark.createDataFrame([("1 2",), ("1 2 3",)], "value string").write.text(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        jobs.run_kmeans(spark, str(tmp_path / "in"), None, k=1, max_iteration=2)


def test_naive_bayes_job_matches_query(spark, tmp_path):
    train, test = Q.q28_sets(spark, SF_SMALL)
    readers.write_tab(train, str(tmp_path / "train"))
    readers.write_tab(test, str(tmp_path / "test"))
    out = jobs.run_naive_bayes(spark, str(tmp_path / "train"), str(tmp_path / "model"),
                               str(tmp_path / "test"), str(tmp_path / "result"))
    got = {(int(r.review_id), r.prediction) for r in out["scored"].collect()}
    want = {(r.doc_id, r.prediction) for r in Q.nb_score(spark, SF_SMALL).collect()}
    assert got == want
    text = [r.value for r in spark.read.text(str(tmp_path / "result")).collect()]
    assert text[2] == "Summary" and text[9] == "Confusion Matrix"


def test_kmeans_job_rejects_empty_input(spark, tmp_path):
    spark.createDataFrame([], "value string").write.text(str(tmp_path / "in"))
    with pytest.raises(RuntimeError, match="is empty"):
        jobs.run_kmeans(spark, str(tmp_path / "in"), None, k=2, max_iteration=2)


def test_kmeans_job_counts_what_it_drops(spark, tmp_path):
    lines = ["1.0 2.0 3.0"] + [f"{i}.0 {i % 7}.5" for i in range(50)] + ["a b", "1.0  2.0", "x"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="width"):
        jobs.run_kmeans(spark, str(tmp_path / "in"), None, k=2, max_iteration=2, mode="drop")
    out = jobs.run_kmeans(spark, str(tmp_path / "in"), None, k=2, max_iteration=2, mode="drop", width=2)
    assert out["rejected"].first().n_rejected == 4 and sum(r.n for r in out["clusters"].collect()) == 50
