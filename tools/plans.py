"""Print the physical plan trees of the main query stages (static plans, AQE off).

Usage: python tools/plans.py [sf_dir] > PLANS.txt
"""

from __future__ import annotations

import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import bayes, evaluate, kmeans, logistic, tfidf  # noqa: E402
from quarry.plans import queries as Q  # noqa: E402
from quarry.session import local_session, materialize  # noqa: E402
from quarry.sources import extract  # noqa: E402


def tree(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().treeString()
    return "\n".join(line for line in plan.splitlines() if line.strip())


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    stages = {}
    stages["q20 features"] = extract.q20_features(spark, sf)
    stages["q26 features"] = extract.q26_features(spark, sf)
    spec = Q.CLUSTER_SPECS["q20"]
    pts = materialize(spec.features(spark, sf))
    model = kmeans.KMeansModel(list(spec.cols), [[0.1 * i] * len(spec.cols) for i in range(8)])
    stages["k-means: assignment"] = kmeans.assign(pts, model)
    stages["naive bayes: tokenise once (materialized)"] = bayes.labelled_buckets(
        Q.q28_labelled(spark, sf), keep=("split",))
    train_b, test_b = Q.q28_buckets(spark, sf)
    stages["naive bayes: token counts per (class, bucket)"] = (
        tfidf.bucket_counts(train_b, "buckets", "label"))
    nb = bayes.fit_buckets(train_b)
    stages["naive bayes: scoring"] = bayes.score_buckets(nb, test_b)
    data = extract.q05_features(spark, sf)
    lr = logistic.LogisticModel(["flag_balance", "flag_segment"], [0.1, -0.2], 0.3)
    stages["logistic: exact AUC"] = evaluate.auc(logistic.score(lr, data), "probability")
    for name, df in stages.items():
        print(f"### {name}\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
