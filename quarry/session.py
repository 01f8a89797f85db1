"""Spark session settings and lineage helpers.

The library never creates a cluster session itself; callers pass one in.
``local_session`` exists for tests and the bench, where no cluster
configuration is present.
"""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package is written for. AQE re-plans joins
# from runtime sizes (broadcast conversion, skew splitting, partition
# coalescing), so the plans below never need to guess sizes up front.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Starting points for a ~100 TB run on ~1000 executors (set them in the cluster's
# session config; the library itself never changes session settings).
CLUSTER_CONF = {
    **RECOMMENDED_CONF,
    # fewer, larger scan tasks on the fact tables (~400k tasks for 100 TB)
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    # start shuffles wide and let AQE coalesce to ~128 MB partitions
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    # a partition 5x the median and over 256 MB is split by the skew join
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
    # runtime broadcast conversion for small measured join sides
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    # bound on hinted broadcasts of tables with a proven row bound (2^20 buckets)
    "quarry.broadcast.maxBoundBytes": str(64 << 20),
    # Arrow batches of documents handed to the token-hash kernel
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # overflow in exact fixed-point sums raises instead of wrapping
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quarry") -> SparkSession:
    """A local session for tests and the bench.

    Sets ``spark.checkpoint.dir`` to a fresh scratch folder only because a
    local run has no shared folder; on a cluster the operator sets it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not checkpoint_dir(spark):
        folder = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session, if any.

    A session in one process (master ``local``), where every folder is shared, gets
    a scratch folder if it names none; a cluster never does.
    """
    live = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not live and spark.sparkContext.master.split("[")[0] == "local":
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp"))
        live = spark.sparkContext.getCheckpointDir()
    return live or None


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` before it is reused by an iterative fit.

    The rows are written as a Parquet table under the shared checkpoint folder and read
    back: one job, compressed columnar files, and a lost executor re-reads files instead
    of re-running the extraction joins. A ``kept_tables`` scope removes the table at its end.
    """
    spark = df.sparkSession
    path = shared_path(spark, "tables")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder for intermediate
    tables and models written by a query: in the innermost open ``kept_tables`` scope, else in the application's folder."""
    base = checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    owner = _SCOPES.get()[-1:] or (_own_folder(spark),)
    return "/".join([base.rstrip("/"), ROOT, *owner, *parts, uuid.uuid4().hex])


# ------------------------------------------------------- lifetime of kept tables (M8)
#
# <checkpoint dir>/quarry/<owner>/...: an owner is a scope, or the application for tables
# written outside of any scope (lazy results may read these as long as the session lives).

ROOT = "quarry"
_SCOPES: contextvars.ContextVar[tuple[str, ...]] = contextvars.ContextVar("quarry_scopes", default=())


def _own_folder(spark: SparkSession) -> str:
    return f"app-{spark.sparkContext.applicationId}"


def _folder(spark: SparkSession, *parts: str):
    """(file system, path) of a folder below the library's own, in whichever store the checkpoint folder is."""
    path = spark._jvm.org.apache.hadoop.fs.Path("/".join([checkpoint_dir(spark).rstrip("/"), ROOT, *parts]))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextlib.contextmanager
def kept_tables(spark: SparkSession):
    """A scope that owns every table which the library stores within it.

    At the end, also when a job failed, the scope's folder goes as a whole. So results that
    are read after it must have been written or collected inside. Scopes nest: the innermost owns.

        with kept_tables(spark):
            queries["q28"](spark, folder).write.parquet(target)
    """
    name = f"scope-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    token = _SCOPES.set((*_SCOPES.get(), name))
    try:
        yield name
    finally:
        _SCOPES.reset(token)
        if checkpoint_dir(spark):
            store, path = _folder(spark, name)
            store.delete(path, True)


def drop_own_tables(spark: SparkSession) -> None:
    """Remove what this application stored outside of scopes, once no result reads it any more."""
    if checkpoint_dir(spark):
        store, path = _folder(spark, _own_folder(spark))
        store.delete(path, True)


def sweep_orphans(spark: SparkSession, older_than_hours: float = 72.0) -> list[str]:
    """Remove the folders of owners that ended without doing so (a lost driver): those in which nothing
    was written for ``older_than_hours``, except this application's. Returns their names.

    Choose the age above the longest run: an owner is known only by the age of its newest file."""
    store, root = _folder(spark)
    if not store.exists(root):
        return []
    own, limit, gone = spark.sparkContext.applicationId, (time.time() - older_than_hours * 3600) * 1000, []
    for status in store.listStatus(root):
        name = status.getPath().getName()
        if own in name:
            continue
        newest, files = status.getModificationTime(), store.listFiles(status.getPath(), True)
        while newest <= limit and files.hasNext():      # one young file is enough
            newest = max(newest, files.next().getModificationTime())
        if newest <= limit:
            store.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
