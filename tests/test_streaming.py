from quarry.operators import kmeans, logistic
from quarry.plans import queries as Q
from quarry.sources import extract
from quarry.streaming import score_batches

from paths import SF_SMALL


def test_stateless_scoring_on_a_stream(spark, tmp_path):
    feats = extract.q05_features(spark, SF_SMALL)
    src = str(tmp_path / "src")
    feats.write.parquet(src)
    model = logistic.fit(feats, ["flag_balance", "flag_segment"], "label", 20, 1.0, 0.001)
    stream = spark.readStream.schema(feats.schema).parquet(src)
    q = (logistic.score(model, stream, keep=("c_customer_sk",)).writeStream
         .format("memory").queryName("lr_scores")
         .option("checkpointLocation", str(tmp_path / "ck1")).start())
    q.processAllAvailable()
    q.stop()
    streamed = sorted(spark.sql("SELECT * FROM lr_scores").collect())
    batch = sorted(logistic.score(model, feats, keep=("c_customer_sk",)).collect())
    assert streamed == batch


def test_assign_and_foreach_batch(spark, tmp_path):
    spec = Q.CLUSTER_SPECS["q20"]
    feats = spec.features(spark, SF_SMALL)
    src = str(tmp_path / "src")
    feats.write.parquet(src)
    model = kmeans.fit(feats, spec.id_col, list(spec.cols), k=8, max_iter=5)
    got = []
    stream = spark.readStream.schema(feats.schema).parquet(src)
    q = score_batches(stream, lambda df: kmeans.assign(df, model),
                      lambda df, epoch: got.extend(df.select("c_custkey", "cluster_id").collect()),
                      str(tmp_path / "ck2"), trigger_once=True)
    q.awaitTermination(120)
    want = kmeans.assign(feats, model).select("c_custkey", "cluster_id").collect()
    assert sorted(got) == sorted(want)
