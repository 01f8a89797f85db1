"""A hot key holding a third of all rows: results stay exact and AQE splits the
skewed join partition instead of sending it to one task."""

import re

import duckdb
from pyspark.sql import functions as F

from quarry.plans import oracle as O
from quarry.sources import extract
from quarry.sources.tables import table

from paths import SF_CHECK

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_part_key(spark, tmp_path):
    folder = str(tmp_path)
    lines = table(spark, SF_CHECK, "lineitem")
    hot = lines.select(F.min("l_partkey")).first()[0]
    skewed = lines.withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(hot))
                              .otherwise(F.col("l_partkey")))
    skewed.repartition(8).write.parquet(f"{folder}/lineitem.parquet")   # several map tasks, as on a real table
    for name in ("part", "orders"):
        table(spark, SF_CHECK, name).write.parquet(f"{folder}/{name}.parquet")
    share = skewed.where(F.col("l_partkey") == hot).count() / skewed.count()
    assert share > 0.3

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        result = extract.q26_features(spark, folder)
        got = sorted(tuple(r) for r in result.collect())
        plan = result._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

    con = duckdb.connect()
    for name in ("lineitem", "part", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    want = sorted(tuple(r) for r in con.execute(O.q26_features_sql()).fetchall())
    assert got == want
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan


def test_hot_customer(spark, tmp_path):
    """A third of all orders belong to one customer: the per-customer sums are
    partial aggregates, so the hot key costs one row per map task in the shuffle."""
    folder = str(tmp_path)
    orders = table(spark, SF_CHECK, "orders")
    hot = orders.select(F.min("o_custkey")).first()[0]
    orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot))
                      .otherwise(F.col("o_custkey"))).repartition(8).write.parquet(f"{folder}/orders.parquet")
    table(spark, SF_CHECK, "lineitem").repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    result = extract.q20_features(spark, folder)
    got = sorted(tuple(r) for r in result.collect())
    plan = result._jdf.queryExecution().executedPlan().toString()
    con = duckdb.connect()
    for name in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    want = sorted(tuple(r) for r in con.execute(O.Q20_FEATURES).fetchall())
    assert got == want
    hot_row = [r for r in got if r[0] == hot][0]
    assert hot_row[4] > 10 * sorted(r[4] for r in got)[len(got) // 2]   # returns of the hot customer
    # a partial aggregate keyed on the customer feeds the exchange on the customer key
    assert re.search(r"HashAggregate\(keys=\[o_custkey#\d+L\], functions=\[partial_", plan), plan
    assert "hashpartitioning(o_custkey" in plan
