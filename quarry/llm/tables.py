"""Input columns and intermediate tables of the operators."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from ..sources.tables import table

UNNAMED = 1 << 62  # rows without a doc_id are placed from here on


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id (as bigint) and the text, under fixed names, whatever else the input carries."""
    return docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].alias("text"))


def wrapped(docs: DataFrame) -> DataFrame:
    """The text, and all other columns in one, ``row``: an operator's columns cannot clash with theirs."""
    return docs.select(docs["text"], F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"))


def unwrapped(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that ``wrapped`` put away."""
    return df.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the cluster's shared folder and read it back.

    Cuts the lineage: what follows survives the loss of executors without
    running the earlier stages again.
    """
    path = shared_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove a table written by ``stored`` once nothing lazy reads it."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_place``, by which documents are ordered and dealt: the doc_id if there is one.

    A row without one gets a place beyond UNNAMED from a hash of its text, so that such rows are dealt
    evenly and reruns agree. Of those with equal texts, one comes before the others, which lose every window
    to it and may share a place. Ids beyond UNNAMED are ordered among these places.
    """
    unnamed = docs.where(docs["doc_id"].isNull())
    if unnamed.isEmpty():
        return docs.withColumn("_place", docs["doc_id"])
    unnamed = stored(unnamed.withColumn("_number", F.monotonically_increasing_id()), "unnamed")
    text = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 60) - 1))
    leads = unnamed.groupBy(text.alias("_text")).agg(F.min("_number").alias("_number")).select("_number", F.lit(0).alias("_follows"))
    place = F.lit(UNNAMED) + 2 * text + F.coalesce("_follows", F.lit(1))
    apart = unnamed.join(leads, "_number", "left").withColumn("_place", place).drop("_number", "_follows")
    return docs.where(docs["doc_id"].isNotNull()).withColumn("_place", F.col("doc_id")).unionByName(apart)


def deal_count(spark: SparkSession) -> int:
    """Number of hash-dealt parts: two for each shuffle partition."""
    return 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(total, bound: int):
    """Column: how many pieces of at most about ``bound`` a total makes, at least 1."""
    return F.greatest(F.lit(1), F.ceil(total / F.lit(bound))).cast("int")


def ceil_div(a: int, b: int) -> int:
    return max(1, math.ceil(a / b))
