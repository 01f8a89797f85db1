"""What jobs read and move: one scan for counts and for all runs, no exchange of rows, no text moved without need."""

import functools
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.operators import bayes, kmeans, logistic, tfidf
from quarry.plans import queries as Q
from quarry.sources import extract, prune, readers

from paths import SF_SMALL


def plan_nodes(df):
    """Nodes of the executed plan, after a run."""
    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
            return
        yield node
        if name.endswith("QueryStageExec"):
            yield from walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))
    return list(walk(df._jdf.queryExecution().executedPlan()))


def metric(node, name):
    return node.metrics().apply(name).value()


# ------------------------------------------------------------- M1: continuous features


def numpy_fit(x, y, passes, rate, lam):
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    w[-1] = 1.0
    for i in range(1, passes + 1):
        step = rate / math.sqrt(i)
        w = w - step * (x.T @ (1 / (1 + np.exp(-x @ w)) - y)) / len(y)
        w = np.sign(w) * np.maximum(0, np.abs(w) - lam * step)
    return w


@pytest.fixture(scope="module")
def continuous():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 7))
    return x, (x[:, 0] - 2 * x[:, 3] + rng.normal(size=3000) > 0).astype(float)


def test_both_plans_and_both_inputs_give_the_same(spark, continuous):
    x, y = continuous
    rows = [(*map(float, r), list(map(float, r)), float(t)) for r, t in zip(x, y)]
    cols = [f"a{j}" for j in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", v array<double>, label double").repartition(9)
    want = numpy_fit(x, y, 12, 1.0, 0.01)
    for model in (logistic.fit(df, cols, "label", 12, 1.0, 0.01), logistic.fit(df, cols, "label", 12, 1.0, 0.01, grouped=True),
                  logistic.fit_vectors(df, "v", "label", 12, 1.0, 0.01), logistic.fit_vectors(df.select("v", "label"), "v", "label", 12, 1.0, 0.01, width=7)):
        assert np.allclose(model.weights + [model.intercept], want, rtol=1e-12, atol=1e-12)
    by_column = logistic.score(logistic.fit(df, cols, "label", 12, 1.0, 0.01), df).orderBy("probability").collect()
    by_vector = logistic.score(logistic.fit_vectors(df, "v", "label", 12, 1.0, 0.01), df).orderBy("probability").collect()
    assert np.allclose([r.probability for r in by_column], [r.probability for r in by_vector], rtol=1e-12)


def test_a_pass_exchanges_sums_not_rows(spark, continuous):
    x, y = continuous
    df = spark.createDataFrame([(list(map(float, r)), float(t)) for r, t in zip(x, y)], "_x array<double>, _y double").repartition(6)
    stored = session.materialize(df)
    model = logistic.LogisticModel([f"x{j}" for j in range(7)], [0.1] * 7, 0.0, vector_col="_x")
    sums = {}

    def spy(frame):     # the frame that a pass collects
        sums["df"] = frame
        return [r for r in collect(frame)]
    collect = type(df).collect
    type(df).collect, kept = spy, type(df).collect
    try:
        logistic._row_sums(stored, None, model)
    finally:
        type(df).collect = kept
    exchanges = [n for n in plan_nodes(sums["df"]) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert len(exchanges) == 1
    assert metric(exchanges[0], "shuffleRecordsWritten") <= (7 + 2) * stored.rdd.getNumPartitions() < 3000


def test_flags_are_grouped_and_continuous_features_are_not(spark, continuous, monkeypatch):
    called = []
    for name in ("_grouped_sums", "_row_sums"):
        real = getattr(logistic, name)
        monkeypatch.setattr(logistic, name, lambda *a, real=real, name=name: (called.append(name), real(*a))[1])
    flags = spark.createDataFrame([(float(i % 2), float(i % 3 == 0), float(i % 5 == 0)) for i in range(200)], "a double, b double, label double")
    logistic.fit(flags, ["a", "b"], passes=2)
    x, y = continuous
    logistic.fit(spark.createDataFrame([(float(a), float(t)) for a, t in zip(x[:, 0], y)], "a double, label double"), ["a"], passes=2)
    assert called == ["_grouped_sums"] * 2 + ["_row_sums"] * 2


def test_incomplete_rows_are_counted(spark):
    rows = [([1.0, 2.0], 1.0), ([0.5, -1.0], 0.0), (None, 1.0), ([1.0, None], 1.0), ([float("nan"), 1.0], 0.0), ([1.0, 1.0], None), ([float("inf"), 0.0], 1.0)]
    df = spark.createDataFrame(rows, "v array<double>, label double")
    model = logistic.fit_vectors(df, "v", passes=3, rate=1.0, lam=0.0)
    want = numpy_fit(np.array([[1.0, 2.0], [0.5, -1.0]]), np.array([1.0, 0.0]), 3, 1.0, 0.0)
    assert model.n_incomplete == 5 and np.allclose(model.weights + [model.intercept], want)
    flat = df.where("v IS NOT NULL").select(F.get("v", F.lit(0)).alias("a"), F.get("v", F.lit(1)).alias("b"), "label")
    for grouped in (True, False, None):
        model = logistic.fit(flat, ["a", "b"], passes=3, rate=1.0, lam=0.0, grouped=grouped)
        assert model.n_incomplete == 4 and np.allclose(model.weights + [model.intercept], want)
    with pytest.raises(Exception, match="has not 2 entries but 3"):
        logistic.fit_vectors(spark.createDataFrame([([1.0, 2.0], 1.0), ([1.0, 2.0, 3.0], 0.0)], "v array<double>, label double"), "v", width=2)
    with pytest.raises(ValueError, match="no training rows"):
        logistic.fit_vectors(df.where("label > 7"), "v")


# --------------------------------------------------- P3, P4: rejects of the same job; S1, S2, S6: found again


def test_rejects_are_counted_by_the_job_that_reads(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for f in range(3):
        (path / f"part-{f}").write_text("".join(f"{i},{i % 2},1,0\n" if i % 7 else f"{i},x,1,0\n" for i in range(f * 100, f * 100 + 100)))
    read = spark.sparkContext._jsc.sc().statusTracker()
    parsed = readers.read_observed(spark, str(path), readers.observe_comma)
    spark.sparkContext.setJobGroup("observed", "")
    good = session.materialize(parsed.good)
    jobs = len(read.getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs == 1
    assert (parsed.n_lines, parsed.n_rejected) == (300, sum(i % 7 == 0 for i in range(300))) and good.count() == 300 - parsed.n_rejected


@pytest.mark.parametrize("split", ["128m", "300"])
def test_rejects_are_found_by_file_and_line(spark, tmp_path, split):
    path, want = tmp_path / "in", set()
    path.mkdir()
    for f in range(4):
        lines = ([",".join(readers.COMMA_FIELDS)] if f % 2 else []) + [f"{i},1,0,1" if i % 11 else f"{i},bad é,0,1" for i in range(f * 50, f * 50 + 60 * f)]
        (path / f"part-{f}.txt").write_text("\n".join(lines))
        want |= {(f"part-{f}.txt", n, x, n == 1 and x.startswith("c_")) for n, x in enumerate(lines, 1) if "bad" in x or x.startswith("c_")}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = readers.located_rejects(spark, str(path), readers.flag_comma).collect()
        vectors = readers.located_rejects(spark, str(path), functools.partial(readers.flag_space, mode="drop", width=3)).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.file.rsplit("/", 1)[1], r.line_no, r.line, r.is_header) for r in got} == want and len(got) == len(want)
    assert vectors == sum(len(p.read_text().splitlines()) for p in path.iterdir())


# ------------------------------------------------------------- Q28: pruning


@pytest.fixture
def pruned(spark):
    """Pruning however small the tables are."""
    spark.conf.set("quarry.prune.minBytes", "0")
    yield
    spark.conf.unset("quarry.prune.minBytes")


def test_small_tables_are_not_pruned(spark):
    rows, keys = (spark.range(n).withColumnRenamed("id", "k") for n in (1000, 10))
    assert prune.keep_possible(rows, keys, "k").count() == 1000


def test_pruning_loses_nothing(spark, pruned):
    keys = spark.createDataFrame([(i * i,) for i in range(500)] + [(None,)] * 3 + [(4,)] * 5, "k bigint")
    rows = spark.range(-1000, 260000).select(F.when(F.col("id") != 7, F.col("id")).alias("k"), F.lit("x").alias("text"))
    kept = prune.keep_possible(rows, keys, "k")
    assert kept.join(keys.distinct(), "k").count() == 500
    assert kept.count() < 500 + 0.06 * 261000
    assert prune.keep_possible(rows, keys.where("k < 0"), "k").count() == 0
    assert prune.filter_words(10 ** 9, 1 << 20) == 0 and prune.filter_words(10 ** 6, 1 << 20) * 8 <= 1 << 20


def test_a_full_filter_is_left_out(spark, pruned):
    keys = spark.range(100).withColumnRenamed("id", "k")
    rows = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("quarry.prune.maxFilterBytes", "64")
    try:
        assert prune.keep_possible(rows, keys, "k").count() == 1000
    finally:
        spark.conf.unset("quarry.prune.maxFilterBytes")
    assert prune.keep_possible(rows, keys.select(F.col("k").cast("int")), "k").count() == 1000     # other type: other hashes


def test_shuffled_texts_grow_with_labels_not_documents(spark, pruned, tmp_path):
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    n = labels.count()
    moved = []
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
              if spark.conf.get(k, None) is not None}
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")
    try:
        for times in (1, 8):
            more = docs
            for i in range(1, times):
                more = more.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1_000_000 * i))
            folder = str(tmp_path / f"x{times}")
            more.write.parquet(f"{folder}/documents.parquet")
            labels.write.parquet(f"{folder}/labels.parquet")
            df = extract.q28_documents(spark, folder)
            df.foreach(lambda r: None)
            df.collect()
            texts = [e for e in plan_nodes(df) if e.getClass().getSimpleName() == "ShuffleExchangeExec" and "text#" in e.output().toString()]
            assert len(texts) == 1
            moved.append(metric(texts[0], "shuffleRecordsWritten"))
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)
    assert moved[0] <= n * 1.2 and moved[1] <= moved[0] + 0.05 * 8 * docs.count()


# ------------------------------------------------------------- M3, A9, M6


def points(spark, n=900, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * 1e-3 + rng.integers(0, 4, size=(n, 1)) * 7.1
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double")


def test_all_runs_share_the_scans(spark, monkeypatch):
    pts, cols, scans = session.materialize(points(spark)), ["a", "b", "c"], []
    real = kmeans._scan
    monkeypatch.setattr(kmeans, "_scan", lambda *a, **b: (scans.append(sorted(a[2])), real(*a, **b))[1])
    best = kmeans.fit_best_of(pts, "id", cols, k=5, max_iter=6, runs=4, seed=3, materialized=True)
    together = list(scans)
    alone = [kmeans.fit(pts, "id", cols, k=5, max_iter=6, init="random", seed=3 + r, materialized=True) for r in range(4)]
    costs = [kmeans.cost(kmeans.assign(pts, m), digits=None).first().cost for m in alone]
    assert best.run_costs == costs and best.centers == alone[costs.index(min(costs))].centers
    assert len(together) == max(m.rounds for m in alone) + 1      # the longest run's rounds, and one for the costs
    assert any(len(runs) < 4 for runs in together[:-1]) == (len({m.rounds for m in alone}) > 1)
    assert [r for runs in together[:-1] for r in runs].count(0) == alone[0].rounds


@pytest.mark.parametrize("parts", [7, 200])
def test_sums_do_not_depend_on_partitions(spark, parts):
    cols = ["a", "b", "c"]
    found = []
    for n in (1, parts):
        pts = points(spark).repartition(n, F.xxhash64("id", F.lit(n)))
        model = kmeans.fit(pts, "id", cols, k=4, max_iter=5)
        docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("label_index", (F.col("doc_id") % 3).cast("int")).repartition(n)
        nb = bayes.fit(docs)
        found.append((model.centers, kmeans.cost(kmeans.assign(pts, model), digits=None).first().cost, nb.totals, nb.pi))
    assert found[0] == found[1]


def test_points_without_a_place_stay_out(spark):
    pts = points(spark).withColumn("b", F.when(F.col("id") % 5 == 0, F.lit(float("nan"))).when(F.col("id") % 7 == 0, None).otherwise(F.col("b")))
    whole = pts.where("b IS NOT NULL AND NOT isnan(b)")
    a, b = (kmeans.fit(p, "id", ["a", "b", "c"], k=3, max_iter=4) for p in (pts, whole))
    assert a.centers == b.centers


def test_a_vector_of_another_width_fails(spark, tmp_path):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    emb.withColumn("embedding", F.when(F.col("vec_id") == 3, F.concat("embedding", "embedding")).otherwise(F.col("embedding"))) \
        .write.parquet(str(tmp_path / "embeddings.parquet"))
    with pytest.raises(Exception, match="has not 64 entries but 128"):
        Q.embeddings_kmeans(spark, str(tmp_path)).collect()


def test_lines_of_other_part_types_are_counted(spark, tmp_path):
    for t in ("lineitem", "orders", "part"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        if t == "part":
            df = df.withColumn("p_type", F.when(F.col("p_partkey") % 3 == 0, "ODD").when(F.col("p_partkey") % 3 == 1, None).otherwise(F.col("p_type")))
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    row = extract.q26_features(spark, str(tmp_path))
    counts = [c for c in row.columns if re.match("n_", c)]
    total = row.agg(*[F.sum(c).alias(c) for c in counts]).first().asDict()
    lines = spark.read.parquet(str(tmp_path / "lineitem.parquet"))
    assert sum(total.values()) == lines.count()
    assert total["n_other"] == lines.where("l_partkey % 3 < 2").count() > 0


# ------------------------------------------------------------- A10, M6: counts


@pytest.mark.parametrize("features,squeeze", [(1 << 20, 1 << 22), (16, 10)])
def test_counts_equal_those_of_exploded_tokens(spark, monkeypatch, features, squeeze):
    monkeypatch.setattr(tfidf, "SQUEEZE", squeeze)
    rows = [(i % 3, [(i * j * 7919) % features for j in range(i % 9)]) for i in range(400)] + [(5, []), (2, [features - 1] * 50)]
    df = spark.createDataFrame(rows, "label int, buckets array<int>").repartition(6)
    want = {}
    for label, buckets in rows:
        for b in buckets:
            want[label, b] = want.get((label, b), 0) + 1
        for b in set(buckets):
            want[None, b] = want.get((None, b), 0) + 1
    got = tfidf.bucket_counts(df, "buckets", "label", features).collect()
    assert {(r.label, r.bucket): r.n for r in got} == want and len(got) == len(want)
    assert {r.bucket: r.df for r in tfidf.frequencies(df, "buckets", features).collect()} == {b: n for (label, b), n in want.items() if label is None}
    assert tfidf.bucket_counts(df.where("label > 9"), "buckets", "label", features).collect() == []


def test_no_plan_holds_a_row_for_a_token(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = tfidf.idf_table(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    train, test = Q.q28_buckets(spark, SF_SMALL)
    model = bayes.fit_buckets(train)
    assert "Generate" not in tfidf.bucket_counts(train, "buckets", "label")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in bayes.score_buckets(model, test)._jdf.queryExecution().executedPlan().toString()
