"""Plan properties: column pruning at the fact-table scans, partial aggregation
before shuffles, and bounded broadcasts only."""

import re

from quarry.plans import queries as Q
from quarry.sources import extract

from paths import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_q20_reads_only_needed_lineitem_columns(spark):
    plan = _plan(extract.q20_features(spark, SF_SMALL))
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(set(x.split("#")[0] for x in s.split(",")) ==
                            {"l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag"}
                            for s in lineitem)


def test_lineitem_is_aggregated_per_order_before_the_orders_join(spark):
    plan = _plan(extract.q26_features(spark, SF_SMALL))
    assert "partial_count" in plan or "partial_sum" in plan
    assert plan.index("HashAggregate(keys=[l_orderkey") < plan.index("FileScan parquet [l_orderkey")


def test_naive_bayes_scoring_does_not_shuffle(spark):
    model, scored = Q.nb_fit_score(spark, SF_SMALL)
    assert "Exchange" not in _plan(scored)


def test_term_counts_do_not_shuffle_by_document(spark):
    assert "Exchange" not in _plan(Q.hash_tf(spark, SF_SMALL))
    assert "hashpartitioning(doc_id" not in _plan(Q.tfidf_weights(spark, SF_SMALL))


def test_naive_bayes_token_counts_are_partial_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    train, _ = Q.q28_buckets(spark, SF_SMALL)
    counts = (train.select("label", F.explode("buckets").alias("bucket"))
              .groupBy("label", "bucket").count())
    plan = _plan(counts)
    assert re.search(r"HashAggregate\(keys=\[label#\d+, bucket#\d+\], functions=\[partial_count", plan), plan
    # no per-document shuffle in training: no exchange keyed on doc_id
    assert "hashpartitioning(doc_id" not in plan
