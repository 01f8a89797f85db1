"""The registered queries on the small tables: SQL where there is some, and the pipeline."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from quarry.llm import queries

from conftest_llm import words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for file in os.listdir(SF):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return db


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, tables, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = tables.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want))


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*queries.QUERIES, "pipeline"} <= {*__spark_entry__.queries()}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, left = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.columns == columns and docs.count() <= left
        left = docs.count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert mixed.count() == left
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, mixed.collect()))


def test_stages_take_any_rows(spark, docs):
    """Nulls, repeated rows, rows without an id, and columns named as the operators name theirs."""
    extra = {"toxicity": "a", "hit_words": "b", "items": "c", "node": "d", "row": "e", "component_id": "f", "doc": "g"}
    more = spark.createDataFrame(
        [(None, "a text without an id"), (None, "another text without an id"), (None, "a text without an id"), (None, None),
         (20, "first text of this id"), (20, "second text of this id"), (20, " ".join(words(60, 1))), (1, "a text that has nothing to do with the other of its id")],
        "doc_id bigint, text string")
    rows = docs.unionByName(more, allowMissingColumns=True).withColumns({c: F.lit(x) for c, x in extra.items()})
    rows = corpus_pipeline.stored(rows, "rows")
    before = {(r.doc_id, r.text) for r in rows.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, rows, SF)
        assert got.columns == rows.columns, name
        found = got.collect()
        assert all(r[c] == x for r in found for c, x in extra.items()), name
        if name == "near_duplicates":
            kept = [(r.doc_id, r.text) for r in found]
            assert len(kept) == len(set(kept)) and set(kept) <= before
            ids = [i for i, _ in kept if i is not None]
            assert {1, 6, 7, 8, 14, 20} <= set(ids) and not {2, 3} & set(ids)
            # different texts under one id stay, and none goes with the copies of the other; of copies one stays
            assert {t for i, t in kept if i == 20} >= {"first text of this id", "second text of this id"}
            assert (1, "a text that has nothing to do with the other of its id") in kept
            assert sum(t == " ".join(words(60, 1)) for _, t in kept) == 1
            # the row without an id that repeats document 1 goes, different texts stay
            assert {t for i, t in kept if i is None} == {"a text without an id", "another text without an id", None}
        if name in ("toxicity", "decontamination"):
            assert len(found) == rows.count()


def test_pipeline_on_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("1 = 0")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), name)
        assert docs.count() == 0
