import math

import numpy as np
import pytest

from quarry.operators import logistic
from quarry.sources import extract

from paths import SF_SMALL


def numpy_sgd(X, y, passes, rate, lam):
    X = np.hstack([X, np.ones((len(X), 1))])
    w = np.zeros(X.shape[1])
    w[-1] = 1.0
    for i in range(1, passes + 1):
        g = ((1.0 / (1.0 + np.exp(-(X @ w))) - y)[:, None] * X).mean(axis=0)
        s = rate / math.sqrt(i)
        v = w - s * g
        w = np.sign(v) * np.maximum(0.0, np.abs(v) - lam * s)
    return w


@pytest.mark.parametrize("cols,lam", [(["flag_balance", "flag_segment"], 0.001),
                                      (["flag_balance", "flag_segment", "label"], 0.1)])
def test_matches_numpy(spark, cols, lam):
    data = extract.q05_features(spark, SF_SMALL)
    pdf = data.toPandas()
    model = logistic.fit(data, cols, "label", passes=20, rate=1.0, lam=lam)
    w = numpy_sgd(pdf[cols].to_numpy(float), pdf["label"].to_numpy(float), 20, 1.0, lam)
    assert np.allclose(model.weights + [model.intercept], w, rtol=1e-9, atol=1e-12)


def test_matches_mllib_sgd(spark):
    import warnings

    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint

    cols = ["flag_balance", "flag_segment"]
    data = extract.q05_features(spark, SF_SMALL)
    rdd = data.rdd.map(lambda r: LabeledPoint(r["label"], [r[c] for c in cols]))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        ref = LogisticRegressionWithSGD.train(rdd, iterations=20, step=1.0, miniBatchFraction=1.0,
                                              regParam=0.01, regType="l1", intercept=True,
                                              convergenceTol=0.0)
    ours = logistic.fit(data, cols, "label", passes=20, rate=1.0, lam=0.01)
    assert np.allclose(ours.weights, list(ref.weights), rtol=1e-7, atol=1e-9)
    assert ours.intercept == pytest.approx(ref.intercept, rel=1e-7, abs=1e-9)


def test_save_load_round_trip(spark, tmp_path):
    data = extract.q05_features(spark, SF_SMALL)
    model = logistic.fit(data, ["flag_balance", "flag_segment"], "label", passes=5, rate=1.0, lam=0.001)
    path = str(tmp_path / "lr")
    logistic.save(model, path)
    back = logistic.load(spark, path)
    assert back.feature_cols == model.feature_cols
    assert back.weights == model.weights and back.intercept == model.intercept


def test_partition_independent(spark):
    data = extract.q05_features(spark, SF_SMALL)
    cols = ["flag_balance", "flag_segment"]
    a = logistic.fit(data.repartition(1), cols, "label", 20, 1.0, 0.001)
    b = logistic.fit(data.repartition(7), cols, "label", 20, 1.0, 0.001)
    # gradient sums are double sums merged in partition order: equal up to the last bits
    assert a.weights + [a.intercept] == pytest.approx(b.weights + [b.intercept], rel=1e-12, abs=1e-15)
