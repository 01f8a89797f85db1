"""What is saved: reports that are replaced whole or not at all, models that are what was saved."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import bayes, logistic, manifest, report

from paths import SF_SMALL


def text(path):
    return "".join(open(f"{path}/{f}").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))


def lines(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "line_no int, line string")


def test_a_report_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "report")
    report.write_text(lines(spark, "a", "b"), path)
    report.write_text(lines(spark, "c", "d", "e"), path + "/")
    assert text(path) == "c\nd\ne\n" and os.listdir(tmp_path) == ["report"]


def test_a_killed_write_leaves_the_former_text(spark, tmp_path):
    path = str(tmp_path / "report")
    report.write_text(lines(spark, "a", "b"), path)
    broken = lines(spark, "c", "d").withColumn("line", F.when(F.col("line_no") == 0, F.col("line")).otherwise(F.raise_error(F.lit("killed")).cast("string")))
    with pytest.raises(Exception, match="killed"):
        report.write_text(broken, path)
    assert text(path) == "a\nb\n" and os.listdir(tmp_path) == ["report"]


@pytest.mark.parametrize("at", [0, 1])
def test_a_failed_rename_leaves_the_former_text(spark, tmp_path, monkeypatch, at):
    path, real, calls = str(tmp_path / "report"), report._renamed, []
    report.write_text(lines(spark, "a", "b"), path)

    def fails(*a):
        calls.append(a)
        if len(calls) == at + 1:
            raise OSError("lost")
        real(*a)
    monkeypatch.setattr(report, "_renamed", fails)
    with pytest.raises(OSError):
        report.write_text(lines(spark, "c"), path)
    assert text(path) == "a\nb\n" and os.listdir(tmp_path) == ["report"]


def test_a_lost_driver_between_the_renames_is_mended(spark, tmp_path):
    path = str(tmp_path / "report")
    report.write_text(lines(spark, "a", "b"), path)
    os.rename(path, path + ".former")
    broken = lines(spark, "c").withColumn("line", F.raise_error(F.lit("killed")).cast("string"))
    with pytest.raises(Exception, match="killed"):
        report.write_text(broken, path)
    assert text(path) == "a\nb\n"


@pytest.fixture
def saved(spark, tmp_path):
    path = str(tmp_path / "model")
    logistic.save(logistic.LogisticModel(["age", "income"], [0.5, -1.25], 0.75, 0.4, n_rejected=3), path)
    return path


def rewritten(spark, path, change):
    rows = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    change(rows).coalesce(1).write.mode("overwrite").parquet(path)


def test_a_model_comes_back(spark, saved):
    model = logistic.load(spark, saved)
    assert (model.feature_cols, model.weights, model.intercept, model.threshold, model.n_rejected) == (["age", "income"], [0.5, -1.25], 0.75, 0.4, 3)
    assert logistic.load(spark, saved, ["income", "age"]).weights == [-1.25, 0.5]


def test_features_are_asked_for_by_name(spark, saved):
    with pytest.raises(manifest.ModelError, match="feature 'height' is not in the model"):
        logistic.load(spark, saved, ["age", "income", "height"])
    with pytest.raises(manifest.ModelError, match="feature 'income' is missing"):
        logistic.load(spark, saved, ["age"])


def test_swapped_terms_fail(spark, saved):
    swap = F.when(F.col("term") == "age", "income").when(F.col("term") == "income", "age").otherwise(F.col("term"))
    rewritten(spark, f"{saved}/weights", lambda df: df.withColumn("term", swap))
    with pytest.raises(manifest.ModelError, match="rows of the model table 'weights'"):
        logistic.load(spark, saved)


def test_missing_columns_and_other_kinds_fail(spark, saved, tmp_path):
    with pytest.raises(manifest.ModelError, match="kind 'logistic'"):
        bayes.load(spark, saved)
    rewritten(spark, f"{saved}/weights", lambda df: df.drop("weight"))
    with pytest.raises(manifest.ModelError, match="column 'weight' of the model table 'weights'.* is missing"):
        logistic.load(spark, saved)
    with pytest.raises(manifest.ModelError, match="no finished model"):
        logistic.load(spark, str(tmp_path / "nothing"))


def test_a_bayes_model_is_checked(spark, tmp_path):
    path = str(tmp_path / "nb")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60).withColumn("label_index", (F.col("doc_id") % 2).cast("int"))
    model = bayes.fit(docs)
    bayes.save(model, path)
    assert bayes.load(spark, path).totals == model.totals
    rewritten(spark, f"{path}/idf", lambda df: df.withColumn("idf", F.when(F.col("bucket") == df.first().bucket, 0.5).otherwise(F.col("idf"))))
    with pytest.raises(manifest.ModelError, match="rows of the model table 'idf'"):
        bayes.load(spark, path)
