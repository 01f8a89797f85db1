import glob
import os
import time

import pytest
from pyspark.sql import functions as F

from quarry import session
from quarry.operators.sizing import broadcast_if_bounded
from quarry.plans.catalog import QUERIES

from paths import SF_SMALL


def test_materialize_writes_to_the_checkpoint_folder(spark):
    folder = session.checkpoint_dir(spark)
    assert folder
    df = spark.range(100).withColumn("y", F.col("id") * 2)
    out = session.materialize(df)
    files = out.inputFiles()
    assert files and all(f.startswith(folder.rstrip("/")) or folder.split(":", 1)[-1] in f for f in files)
    assert sorted(r.y for r in out.collect()) == [2 * i for i in range(100)]


def test_materialize_needs_a_shared_folder(spark, monkeypatch):
    """Without one, tables could only be kept on machines that may be lost."""
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.materialize(spark.range(10))


def left_over(spark):
    """Files below the library's folder that are not this application's own."""
    root = os.path.join(session.checkpoint_dir(spark).split("file:")[-1], session.ROOT)
    return [f for f in glob.glob(root + "/**", recursive=True) if os.path.isfile(f) and "/app-" not in f]


def test_a_scope_owns_what_is_stored_in_it(spark):
    with session.kept_tables(spark):
        outer = session.materialize(spark.range(10))
        with session.kept_tables(spark):
            inner = session.materialize(spark.range(20))
            assert inner.count() == 20 and left_over(spark)
        assert outer.count() == 10
        with pytest.raises(Exception):
            spark.read.parquet(inner.inputFiles()[0])
    assert left_over(spark) == []


def test_a_scope_ends_with_a_failed_job(spark):
    broken = spark.range(10).select(F.when(F.col("id") < 5, F.col("id")).otherwise(F.raise_error(F.lit("on purpose")).cast("bigint")).alias("x"))
    with pytest.raises(Exception, match="on purpose"):
        with session.kept_tables(spark):
            session.materialize(spark.range(10))
            session.materialize(broken)
    assert left_over(spark) == []


@pytest.mark.parametrize("name", ["q28", "q20", "logistic_auc", "nb_roundtrip", "report_text"])
def test_queries_leave_nothing_behind(spark, name):
    with session.kept_tables(spark):
        assert QUERIES[name](spark, SF_SMALL).collect()
        assert left_over(spark)
    assert left_over(spark) == []


def test_sweep_takes_old_orphans_only(spark):
    root = os.path.join(session.checkpoint_dir(spark).split("file:")[-1], session.ROOT)
    old, young = "scope-gone-1", "scope-gone-2"
    for name in (old, young):
        os.makedirs(f"{root}/{name}/tables/a")
        for file in ("part-0", "part-1"):
            open(f"{root}/{name}/tables/a/{file}", "w").write("x")
    then = time.time() - 10 * 3600
    for path in (f"{root}/{old}/tables/a/part-0", f"{root}/{old}/tables/a/part-1", f"{root}/{old}", f"{root}/{young}/tables/a/part-0", f"{root}/{young}"):
        os.utime(path, (then, then))        # one file of the young one was written just now
    kept = session.materialize(spark.range(3))
    assert session.sweep_orphans(spark, older_than_hours=5) == [old]
    assert not os.path.exists(f"{root}/{old}") and os.path.exists(f"{root}/{young}") and kept.count() == 3
    assert young in session.sweep_orphans(spark, older_than_hours=0) and kept.count() == 3
    session.drop_own_tables(spark)
    assert not os.path.exists(f"{root}/app-{spark.sparkContext.applicationId}")


def test_shared_paths_are_fresh(spark):
    a, b = session.shared_path(spark, "x"), session.shared_path(spark, "x")
    assert a != b and a.split("/")[-4] == "quarry" and "/x/" in a


def _plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_broadcast_only_under_proven_bound(spark):
    small = spark.range(10)
    assert "broadcast" in _plan(broadcast_if_bounded(small, 1 << 20, 16)).lower()
    assert "broadcast" not in _plan(broadcast_if_bounded(small, 1 << 30, 16)).lower()
