"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from quarry.sources.tables import TABLE_NAMES

from paths import SF_SMALL

ORACLE = E.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_against_oracle(spark, duck, name):
    result = E.queries()[name](spark, SF_SMALL)
    got = result.toPandas()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, plan
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = duck.execute(ORACLE[name]).df()
    assert _rows(got) == _rows(want)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in result.schema.fields}
    duck_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {ORACLE[name]}").fetchall()}
    assert spark_types == duck_types


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 8
    assert df.columns[0] == "cluster_id"
