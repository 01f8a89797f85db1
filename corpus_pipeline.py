"""Preparing a training corpus from the table ``documents``: five stages, one after the other.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns
the columns of ``documents``; the last one returns how many words the mix takes of each
document. ``run`` writes every stage's rows as Parquet in the shared folder and reads
them again, so that a lost executor never reaches back into an earlier stage.

Defined cases: other columns pass through unchanged, whatever they are called; empty tables
give no rows; each operator's docstring tells how it takes nulls, empty texts and repeated rows.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.llm import decontaminate, mixing, neardup, recompression, toxicity  # noqa: E402
from quarry.llm.tables import documents, stored, unwrapped, wrapped  # noqa: E402
from quarry.sources.tables import table  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; learned from all labelled ones among ``docs``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(wrapped(docs), model)
    return unwrapped(scored.where(F.col("toxicity") < toxicity.THRESHOLD), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group.

    A document is a distinct id and text. Where rows share an id but not the text, the text with the
    least hash goes under the id, and each other one stands after all ids, under one made from its id and text; so does
    a row without an id, under one made from its text. So a text goes only if it is a copy or near copy.
    """
    rows = wrapped(docs).withColumns({"id": F.col("row.doc_id").cast("bigint"), "h": F.xxhash64("text")})
    # ids that several texts share: few or none; written first, so that its size is known to the join
    shared = stored(rows.where("id IS NOT NULL").groupBy(F.col("id").alias("shared")).agg(F.min("h").alias("least"), F.max("h").alias("most"))
                    .where("least != most").drop("most"), "shared_ids")
    made = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("id", "h"), 3)
    own = F.when(F.col("id").isNotNull() & (F.col("least").isNull() | (F.col("least") == F.col("h"))), F.col("id")).otherwise(made)
    rows = rows.join(shared, rows["id"] == shared["shared"], "left").select("text", "row", own.alias("node"))
    kept = neardup.near_duplicates(rows, id_col="node").where("kept").select(F.col("doc_id").alias("stays")).distinct()
    first = Window.partitionBy("node").orderBy(F.to_json("row"))
    left = rows.join(kept, rows["node"] == kept["stays"], "left_semi").withColumn("place", F.row_number().over(first))
    return unwrapped(left.where("place = 1"), docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that repeat an earlier passage; untouched ones as they were, emptied ones dropped."""
    return recompression.cut(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.find_items(wrapped(docs), table(spark, sf_dir, "benchmark"))
    return unwrapped(found.where(F.size("hit_words") == 0), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source, source_size, target, shard, quota, taken of each document."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

ORACLE_SQL = None  # the toxicity model is trained: no SQL expresses it


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
