import math
import re
from collections import Counter

import pytest

from quarry.functions.text import stop_words
from quarry.operators import bayes
from quarry.plans import queries as Q

from paths import SF_SMALL
from test_text import java_bucket

B = 1 << 20


def python_buckets(text):
    """The original per-document cleaning, as plain Python."""
    stop = set(stop_words())
    cleaned = "".join(" " + t.lower() for t in re.split("[^a-zA-Z]", text)
                      if t and t.lower() not in stop)
    return Counter(java_bucket(w) for w in cleaned.split(" "))


def python_tfidf(docs):
    n = len(docs)
    df = Counter(b for _, _, tf in docs for b in tf)
    idf = {b: math.log((n + 1.0) / (c + 1.0)) for b, c in df.items()}
    return [(d, y, {b: c * idf[b] for b, c in tf.items()}) for d, y, tf in docs]


def python_nb(train, test):
    classes = sorted({y for _, y, _ in train})
    nc = Counter(y for _, y, _ in train)
    s = {c: Counter() for c in classes}
    for _, y, v in train:
        s[y].update(v)
    st = {c: sum(s[c].values()) for c in classes}
    pi = {c: math.log(nc[c] + 1.0) - math.log(len(train) + len(classes)) for c in classes}
    out = {}
    for d, _, v in test:
        scores = [(pi[c] + sum(x * (math.log(s[c].get(b, 0.0) + 1.0) - math.log(st[c] + B))
                               for b, x in v.items()), c) for c in classes]
        out[d] = max(scores, key=lambda t: (t[0], -t[1]))[1]
    return out


@pytest.fixture(scope="module")
def q28_data(spark):
    train, test = Q.q28_sets(spark, SF_SMALL)
    rows = lambda df: [(r.doc_id, r.label_index, python_buckets(r.text))
                       for r in df.select("doc_id", "label_index", "text").collect()]
    return train, test, rows(train), rows(test)


def test_matches_python_reference(spark, q28_data):
    train, test, ptrain, ptest = q28_data
    expect = python_nb(python_tfidf(ptrain), python_tfidf(ptest))
    model = bayes.fit(train)
    got = {r.doc_id: r.prediction for r in bayes.score(model, test).collect()}
    assert got == expect
    assert model.n_train == len(ptrain)


def test_empty_document_scored_by_prior(spark, q28_data):
    train, _, _, _ = q28_data
    model = bayes.fit(train)
    docs = spark.createDataFrame([(1, 0, "the and of"), (2, 1, "")],
                                 "doc_id long, label_index int, text string")
    got = {r.doc_id: r.prediction for r in bayes.score(model, docs, idf_from="train").collect()}
    best = max(model.classes, key=lambda c: (model.pi[c], -c))
    assert got == {1: best, 2: best}


def test_save_load(spark, q28_data, tmp_path):
    train, test, _, _ = q28_data
    model = bayes.fit(train)
    bayes.save(model, str(tmp_path / "nb"))
    back = bayes.load(spark, str(tmp_path / "nb"))
    a = sorted(bayes.score(model, test).collect())
    b = sorted(bayes.score(back, test).collect())
    assert a == b


def test_matches_spark_ml_naive_bayes(spark, q28_data):
    """Same TF-IDF vectors into Spark ML's NaiveBayes: same log priors, thetas and predictions."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.linalg import SparseVector

    from quarry.operators import tfidf

    train, test, _, _ = q28_data

    def vectors(docs):
        weights = tfidf.tfidf(docs.select("doc_id", "text")).collect()
        per_doc = {}
        for r in weights:
            if r.tfidf != 0.0:
                per_doc.setdefault(r.doc_id, {})[r.bucket] = r.tfidf
        labels = {r.doc_id: float(r.label_index) for r in docs.select("doc_id", "label_index").collect()}
        rows = [(d, labels[d], SparseVector(B, sorted(per_doc.get(d, {}).items()))) for d in labels]
        return spark.createDataFrame(rows, ["doc_id", "label", "features"])

    ml = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(vectors(train))
    ours = bayes.fit(train)
    assert list(ml.pi.toArray()) == pytest.approx([ours.pi[c] for c in ours.classes], rel=1e-12)
    theta = {(r.label, r.bucket): r.theta for r in ours.theta().collect()}
    dense = ml.theta.toArray()
    for (c, b), t in theta.items():
        assert dense[c][b] == pytest.approx(t, rel=1e-9)
    got = {r.doc_id: r.prediction for r in bayes.score(ours, test).collect()}
    ref = {r.doc_id: int(r.prediction) for r in ml.transform(vectors(test)).collect()}
    assert got == ref


def test_partition_independent(spark, q28_data):
    train, test, _, _ = q28_data
    a = sorted(bayes.score(bayes.fit(train.repartition(1)), test.repartition(1)).collect())
    b = sorted(bayes.score(bayes.fit(train.repartition(7)), test.repartition(5)).collect())
    assert a == b


def test_hot_bucket_matches_python_reference(spark, q28_data):
    """One word appended 200 times to every document: a single bucket then holds
    a large share of all tokens, and results still equal the brute force."""
    from pyspark.sql import functions as F

    train, test, _, _ = q28_data
    hot = " ".join(["zebra"] * 200)
    train_h = train.withColumn("text", F.concat(F.col("text"), F.lit(" " + hot)))
    test_h = test.withColumn("text", F.concat(F.col("text"), F.lit(" " + hot)))
    rows = lambda df: [(r.doc_id, r.label_index, python_buckets(r.text))
                       for r in df.select("doc_id", "label_index", "text").collect()]
    expect = python_nb(python_tfidf(rows(train_h)), python_tfidf(rows(test_h)))
    got = {r.doc_id: r.prediction for r in bayes.score(bayes.fit(train_h), test_h).collect()}
    assert got == expect
